"""Candidates of the Jaccard join: sketches bound differences, and shared phrases make no blocks."""

import os
import random
from urllib.parse import urlparse

import numpy as np
import pytest

from skyledger.llm import common, components, jaccard
from skyledger.llm.words import mix
from skyledger.session import freeing_shuffles


def hashes(numbers):
    return np.unique(mix(np.array(sorted(numbers), dtype=np.uint64)))


def families(chance, members=8):
    """Sets of many sizes, each a few shingles away from another."""
    for size in (2, 7, 15, 33, 120, 700, 5000):
        base = [chance.randrange(1 << 60) for _ in range(size)]
        for _ in range(members):
            kept = chance.sample(base, max(1, size - chance.randrange(0, size // 6 + 1)))
            yield hashes(set(kept) | {chance.randrange(1 << 60) for _ in range(chance.randrange(0, size // 12 + 1))})


def linked(rule, x, y):
    return rule.enough(len(np.intersect1d(x, y)), len(x), len(y))


@pytest.mark.parametrize("percent", (80, 85))
def test_sketches_lose_no_link(percent):
    rule, sets = jaccard.Jaccard(percent, 4), list(families(random.Random(percent)))
    sets.append(hashes(range(40_000)))
    pairs = [(x, y) for i, x in enumerate(sets) for y in sets[i:] if linked(rule, x, y)]
    assert len(pairs) > len(sets)
    assert all(rule.may_link(len(x), rule.sketch(x), len(y), rule.sketch(y)) for x, y in pairs)
    others = [(x, y) for i, x in enumerate(sets) for y in sets[i + 8 :] if min(len(x), len(y)) > 30]
    assert not any(rule.may_link(len(x), rule.sketch(x), len(y), rule.sketch(y)) for x, y in others)


def test_class_links_connect_what_links_connect():
    rule, sets = jaccard.Jaccard(80, 4), list(families(random.Random(4)))
    classes = [k - k % 2 for k in range(len(sets))]  # every other pair is known already
    links = jaccard.class_links(classes, [len(s) for s in sets], [rule.sketch(s) for s in sets], rule)
    forest = components.Forest()
    for a, b in links:
        forest.join(a, b)
    for i, x in enumerate(sets):
        for j, y in enumerate(sets):
            assert not linked(rule, x, y) or forest.root(classes[i]) == forest.root(classes[j])
    assert len(links) < len(set(classes))


def test_shared_phrases_make_no_block(spark, monkeypatch):
    """600 texts that share phrases two by two, of which only two are near copies: no other set is compared."""
    common.ship(spark)
    chance, held = random.Random(6), []
    phrases = [[f"p{i}.{k}" for k in range(24)] for i in range(12)]
    texts = [[f"w{chance.random()}" for _ in range(26)] + chance.choice(phrases) + [f"v{chance.random()}" for _ in range(12)] for _ in range(600)]
    texts.append([*texts[0][:-1], "other"])

    def kept(df, name):
        out = common.written(df, name)
        if name == "blocks":
            held.append(out.count())
        return out

    monkeypatch.setattr(jaccard, "written", kept)
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    got = {r["doc_id"]: r["component_id"] for r in jaccard.jaccard_components(docs).collect()}
    assert got == {i: 0 if i == 600 else i for i in range(601)}
    assert held == [2]


@pytest.mark.parametrize("few", (0, 40))
def test_components_by_rounds_and_in_the_last_task(spark, monkeypatch, few):
    monkeypatch.setattr(components, "FEW", few)
    common.ship(spark)
    chance = random.Random(9)
    links = [(i, i + 1) for i in range(150)] + [(chance.randrange(1000, 1200), chance.randrange(1000, 1200)) for _ in range(150)]
    forest = components.Forest()
    for a, b in links:
        forest.join(a, b)
    got = {r["node"]: r["component"] for r in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {node: forest.root(node) for link in links for node in link}


def test_writes_free_their_shuffles(spark):
    """Shuffle files of a written table are gone with the write, not with the driver's next collection."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    local = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in local for _, _, names in os.walk(urlparse(d).path) for f in names if f.startswith("shuffle_")}

    old = files()
    back = common.written(spark.range(20_000).selectExpr("id % 977 AS k").groupBy("k").count(), "freed")
    assert not files() - old
    assert back.count() == 977
    assert spark.conf.get(setting) == before
    with freeing_shuffles(spark), freeing_shuffles(spark):
        assert spark.conf.get(setting) == "true"
    assert spark.conf.get(setting) == before
