"""Connected components, and how many links near copies leave for them."""

import random

import pytest
from pyspark.sql import functions as F

from skyledger.llm import common, jaccard
from skyledger.llm import components as module
from skyledger.llm.components import components


def brute(links):
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {node: find(node) for node in root}


def shapes():
    chance = random.Random(3)
    ids = [chance.randrange(-(1 << 62), 1 << 62) for _ in range(300)]
    yield [(i, i + 1) for i in range(200)]
    yield [(i + 1, i) for i in range(200)] + [(500, 500), (7, 7)]
    yield [(0, i) for i in range(1, 300)] + [(-5, 299), (1000, 1001)] * 3
    yield [(chance.choice(ids), chance.choice(ids)) for _ in range(250)]
    yield []


@pytest.mark.parametrize("shape", range(5))
def test_components_against_union_find(spark, shape):
    common.ship(spark)
    links = list(shapes())[shape]
    df = spark.createDataFrame(links, "a long, b long").repartition(4)
    assert {r["node"]: r["component"] for r in components(df).collect()} == brute(links)
    forest = module.spanning(df).collect()
    apart = brute([tuple(r) for r in forest])
    loops = {a for a, b in links if a == b}
    assert {n: c for n, c in brute(links).items() if n not in loops or n != c} == {n: c for n, c in apart.items() if n not in loops or n != c}


def test_near_copies_leave_few_links(spark, monkeypatch):
    """2,000 near copies share many keys with many different leads: two links a set at most go into the rounds."""
    common.ship(spark)
    chance = random.Random(8)
    base = [f"w{i}" for i in range(300)]

    def near():
        words = list(base)
        for _ in range(4):
            words[chance.randrange(300)] = f"x{chance.random()}"
        return " ".join(words)

    docs = spark.createDataFrame([(i, near()) for i in range(2000)], "doc_id long, text string").repartition(4)
    seen = []
    plain = module.written

    def counted(df, name):
        out = plain(df, name)
        if name == "links":
            seen.append(out.count())
        return out

    monkeypatch.setattr(module, "written", counted)
    got = jaccard.jaccard_components(docs, jaccard.Jaccard(percent=85, width=4))
    assert got.select(F.min("component_id"), F.max("component_id")).first() == (0, 0)
    assert seen and max(seen) <= 2 * 2000


def joined_rows(plan):
    """Rows out of every join of an executed plan, those of its stages included."""
    name = plan.nodeName()
    if "AdaptiveSparkPlan" in name:
        return joined_rows(plan.executedPlan())
    if name.endswith("QueryStage"):
        return joined_rows(plan.plan())
    own = plan.metrics().apply("numOutputRows").value() if "Join" in name else 0
    children = plan.children()
    return own + sum(joined_rows(children.apply(i)) for i in range(children.size()))


def test_following_the_hooks_joins_few_rows(spark, monkeypatch):
    """A long path takes many rounds; the rows joined at the end do not grow with their number."""
    common.ship(spark)
    rows = []

    def counted(df, name):
        if name == "labels":
            df.collect()
            rows.append(joined_rows(df._jdf.queryExecution().executedPlan()))
        return common.written(df, name)

    monkeypatch.setattr(module, "written", counted)
    links = spark.createDataFrame([(i, i + 1) for i in range(3000)], "a long, b long")
    assert components(links).where("component = 0").count() == 3001
    assert 3001 <= rows[0] <= 3 * 3001, rows
