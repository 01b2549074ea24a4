"""Connected components: a node with very many links, chains, plain groups."""

import random

from eddyflow.llm.components import SALTS, _with_min, components


def _plain(links):
    of = {}

    def root(x):
        while of.setdefault(x, x) != x:
            x = of[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        of[max(a, b)] = min(a, b)
    return {x: root(x) for x in of}


def test_stars_chains_and_groups_against_union_find(spark):
    rng = random.Random(5)
    star = [(5000, 6000 + i) for i in range(1500)]
    chain = [(i + 1, i) for i in range(20, 60)]
    loose = [(rng.randrange(100, 400), rng.randrange(100, 400)) for _ in range(150)]
    links = [(a, b) for a, b in star + chain + loose if a != b]
    rows = components(spark.createDataFrame(links + links[:100], "a bigint, b bigint")).collect()
    assert len(rows) == len({r["node"] for r in rows})
    assert {r["node"]: r["component"] for r in rows} == _plain(links)


def test_a_hot_node_is_joined_in_parts(spark):
    pairs = spark.createDataFrame([(7, i) for i in range(100, 4100)] + [(8, 3), (9, -1)], "u bigint, v bigint")
    got = _with_min(pairs)
    assert {tuple(r) for r in got.collect()} == {(7, i, 7) for i in range(100, 4100)} | {(8, 3, 3), (9, -1, -1)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "pmod(xxhash64(" in plan and SALTS == 64


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
