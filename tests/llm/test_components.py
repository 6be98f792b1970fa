from __future__ import annotations

import random

import pytest

from tidemark.llm.components import connected


def _roots(links):
    least = {n: n for link in links for n in link}
    while True:
        before = dict(least)
        for a, b in links:
            least[a] = least[b] = min(least[a], least[b])
        if least == before:
            return {n: r for n, r in least.items() if n != r}


@pytest.mark.parametrize(
    "links",
    [
        [],
        [(3, 3)],
        [(2, 1), (3, 1), (5, 4)],
        [(i, i + 1) for i in range(40)],
        [(9, 1), (9, 2), (8, 2), (8, 3), (1, 9)],
        [(random.Random(i).randrange(90), random.Random(~i).randrange(90)) for i in range(70)],
    ],
    ids=["none", "itself", "stars", "path", "several parents", "random"],
)
def test_every_node_gets_the_least_it_reaches(spark, links):
    frame = spark.createDataFrame([*links, (None, 1)], "a long, b long")
    found = connected(frame).collect()
    want = _roots([x for x in links if x[0] != x[1]])
    assert len(found) == len(want) and {r["id"]: r["root"] for r in found} == want
