from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregate


def test_group_stats_leave_the_join_to_the_planner(spark):
    df = spark.sql("select * from values ('a', 1), ('a', 3), (null, 5) v(g, v)")
    few = aggregate.with_group_stats(df, ["g"], {"s": F.sum("v")})
    assert "ResolvedHint" not in few._jdf.queryExecution().analyzed().toString()
    assert sorted(map(tuple, few.collect()), key=str) == [("a", 1, 4), ("a", 3, 4), (None, 5, 5)]
