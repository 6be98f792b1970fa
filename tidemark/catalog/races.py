from __future__ import annotations

from tidemark.catalog.registry import query
from tidemark.plans import races as f


@query(
    "driver_points",
    """SELECT forename AS driver_forename, surname AS driver_surname,
              nationality AS driver_nationality,
              CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS points
       FROM lineitem JOIN v_drivers ON driver_id = l_partkey GROUP BY ALL""",
)
def _(w):
    return f.driver_points(w.results, w.drivers)


@query(
    "top5_constructor_points",
    """SELECT ref AS "constructorRef", name AS cons_name, nationality AS cons_nationality, url,
              CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS points
       FROM lineitem JOIN v_constructors ON constructor_id = l_suppkey
            JOIN orders ON o_orderkey = l_orderkey
       GROUP BY ALL ORDER BY points DESC, ref LIMIT 5""",
)
def _(w):
    return f.top_constructor_points(w.results, w.constructors, w.races)


@query(
    "constructor_points_race_year",
    """SELECT ref AS "constructorRef", name AS cons_name, nationality AS cons_nationality, url,
              CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS points
       FROM lineitem JOIN v_constructors ON constructor_id = l_suppkey
            JOIN orders ON o_orderkey = l_orderkey
       WHERE o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1996
       GROUP BY ALL ORDER BY points DESC, ref LIMIT 5""",
)
def _(w):
    return f.constructor_points_race_year(
        w.results, w.constructors, w.races, "1-URGENT", 1996
    )
