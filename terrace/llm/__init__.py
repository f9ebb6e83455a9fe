"""Operators for preparing training text: mixing, deduplication, token counts, quality, archives, packing.

Nothing else in the library imports this package. Every operator takes DataFrames and
returns DataFrames; ``catalog`` registers one query per operator.
"""
