"""Layered (landing, bronze, silver, gold) analytics as plain Spark functions.

``functions``  Column -> Column helpers
``operators``  DataFrame -> DataFrame operators: quality rules, change capture, joins
``sources``    file and table readers
``streaming``  Structured Streaming writers and incremental change capture
``plans``      the bank, sales and users datasets built from the above
"""
