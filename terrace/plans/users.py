"""Sample users: a projection and e-mail validity per user type."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace import fixed_values as fixed
from terrace.functions import is_valid_email


def sample_users(users: DataFrame) -> DataFrame:
    """The columns of users in use."""
    return users.select(*fixed.USER_COLUMNS)


def users_by_type(users: DataFrame) -> DataFrame:
    """Users and users with a valid e-mail per type."""
    return (
        users.withColumn("valid_email", is_valid_email(F.col("email")))
        .groupBy("user_type")
        .agg(F.count("user_id").alias("total_count"), F.count_if("valid_email").alias("count_valid_emails"))
    )
