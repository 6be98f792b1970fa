"""Users seen under the same address in two monthly logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.relational import join_on

USER_LOG = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("first_name", T.StringType()),
        T.StructField("last_name", T.StringType()),
        T.StructField("email", T.StringType()),
        T.StructField("ip_address", T.StringType()),
    ]
)


def same_ip_across_months(may: DataFrame, april: DataFrame) -> DataFrame:
    """A left join keeping only matches is an inner join, which can be skew-split."""
    earlier = april.select(
        F.col("first_name").alias("first_name_april"),
        F.col("last_name").alias("last_name_april"),
        F.col("ip_address").alias("ip_april"),
    )
    return join_on(may, earlier, [("ip_address", "ip_april")]).select(
        "id",
        F.col("first_name").alias("first_name_may"),
        F.col("last_name").alias("last_name_may"),
        "first_name_april",
        "last_name_april",
        "ip_address",
    )
