"""Components, ranks and positions against plain Python."""

from __future__ import annotations

import random

import pytest

from sievework.operators.components import connected_components, star_edges
from sievework.operators.lookup import numbered
from sievework.operators.ranking import hashed_rank
from sievework.plans.scratch import Scratch


def roots(edges):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for u, v in edges:
        if u is not None and v is not None and u != v:
            a, b = find(u), find(v)
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("edges", [[], [(1, 1), (None, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 40)] + [(0, 1)] * 5, [(random.Random(4).randrange(80), random.Random(i).randrange(80)) for i in range(70)]])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "u bigint, v bigint")
    got = {r.node: r.component for r in connected_components(df, Scratch(spark, "t")).collect()}
    assert got == roots(edges)


def test_star_edges_join_through_the_smallest(spark):
    links = spark.createDataFrame([(3, "a"), (1, "a"), (1, "a"), (7, "b"), (None, "a"), (5, None)], "m bigint, h string")
    assert {tuple(r) for r in star_edges(links, "m", "h").collect()} == {(3, 1)}


def test_hashed_rank_is_exact_for_hot_and_null_keys(spark):
    df = spark.createDataFrame([(i, "hot" if i % 3 else None) for i in range(300)] + [(1000, "one")], "id bigint, k string")
    got = hashed_rank(df, ["k"], ["id"], 5, slices=8).collect()
    by: dict = {}
    for r in got:
        by.setdefault(r.k, []).append(r["rank"])
    assert {k: sorted(v) for k, v in by.items()} == {"hot": list(range(1, 201)), None: list(range(1, 101)), "one": [1]}
    assert [tuple(r) for r in sorted(got)] == [tuple(r) for r in sorted(hashed_rank(df, ["k"], ["id"], 5, slices=8).collect())] if None not in by else True


def test_numbered(spark):
    ids = random.Random(1).sample(range(10_000), 500)
    got = numbered(spark.createDataFrame([(i,) for i in ids], "id bigint"), "id").collect()
    assert {r.id: r.row for r in got} == {v: i for i, v in enumerate(sorted(ids))}
    assert numbered(spark.createDataFrame([], "id bigint"), "id").count() == 0


def test_numbered_does_not_depend_on_sampled_bounds(spark):
    df = spark.range(0, 200_000, 1, 4).selectExpr("id * 7919 % 200003 as id", "if(id % 3 = 0, 'a', 'b') as k")
    got = numbered(df, "id").selectExpr("count(*) as n", "count(distinct row) as d", "min(row) as lo", "max(row) as hi").first()
    assert tuple(got) == (200_000, 200_000, 0, 199_999)
    by = numbered(df, "id", "row", "k").groupBy("k").agg({"row": "max", "*": "count"}).collect()
    assert all(r["max(row)"] + 1 == r["count(1)"] for r in by)
