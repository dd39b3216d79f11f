"""Operators 11 to 13 against brute force, and their edge cases on small fixtures."""

import math
import random
import re
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyledger.llm import common, queries, ranked_search, toxicity, whitening

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
DOCS = "doc_id long, text string, lang string, score long, rank string, item int, terms string"
VECTORS = "vec_id long, embedding array<float>, label int, row string, component string"


def document(i, text):
    return (i, text, "xx", -5, "r", 1, "t")


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    common.ship(spark)


# ranked search


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def brute_ranking(documents, items, k):
    found = [(i, TERM.findall(lowered(text))) for i, text in documents]
    big_n, big_l = sum(bool(t) for _, t in found), sum(len(t) for _, t in found)
    df = Counter(t for _, every in found for t in set(every))
    out = []
    for item_id, text in items:
        scores = []
        for i, every in found:
            if not every:
                continue
            tf, m, score = Counter(every), 75 + (25 * len(every) * big_n) // big_l, 0
            for term in TERM.findall(lowered(text)):
                if tf[term]:
                    w = math.floor(1000 * math.log((2 * big_n + 2) / (2 * df[term] + 1)))
                    score += w * ((1_000_000_000 * tf[term]) // (1000 * tf[term] + 12 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item_id, rank, i, -s) for rank, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out, key=str)


def corpus(seed, n):
    chance = random.Random(seed)
    words = [f"{a}{b}" for a in "klmnprst" for b in ("a", "e", "io", "ü", "OO", "7")]
    sets = [chance.sample(words, 20) for _ in range(4)]
    texts = [" ".join(chance.choices(chance.choice(sets), k=chance.randrange(1, 60))) for _ in range(n)]
    rows = [(i, text + ".") for i, text in enumerate(texts)]
    rows += [(n + i, rows[3][1]) for i in range(40)]  # ties beyond k
    rows += [(n + 100, None), (n + 101, ""), (n + 102, " .,;\t"), (None, rows[3][1]), (5, rows[5][1]), (n + 103, " ".join(words * 3000))]
    items = [(i, " ".join(chance.choices(chance.choice(sets), k=12))) for i in range(30)]
    items += [(90, None), (91, ""), (92, "nowhere at-all"), (93, rows[3][1]), (94, items[0][1]), (95, items[0][1].upper())]
    return rows, items


def test_ranked_search_is_exact(spark):
    rows, items = corpus(1, 400)
    docs = spark.createDataFrame([document(*r) for r in rows], DOCS).repartition(5)
    bench = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, score string")
    got = sorted((tuple(r) for r in ranked_search.ranked(docs, bench, 7).collect()), key=str)
    assert got == brute_ranking(rows, items, 7)


def test_ranked_search_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(ranked_search, "BLOCK_ITEMS", 6)
    rows, items = corpus(2, 100)
    docs = spark.createDataFrame([document(*r) for r in rows], DOCS)
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((tuple(r) for r in ranked_search.ranked(docs, bench).collect()), key=str)
    assert got == brute_ranking(rows, items, 20)


def test_ranked_search_empty(spark):
    docs, bench = spark.createDataFrame([], DOCS), spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([document(1, "a b"), document(2, None)], DOCS)
    item = spark.createDataFrame([(1, "a"), (2, "?")], "item_id long, text string")
    assert queries.op13(docs, bench).collect() == queries.op13(some, bench).collect() == queries.op13(docs, item).collect() == []
    blank = spark.createDataFrame([document(1, " "), document(2, None)], DOCS)
    assert queries.op13(blank, item).collect() == []


def test_dual_tree_prunes_whole_batches():
    """Items and documents of separate vocabularies: most pairs are never scored."""
    chance = np.random.default_rng(0)
    starts, columns, weights = [0], [], []
    for i in range(64):
        columns.append(np.sort(chance.choice(20, 8, replace=False)) + 1 + 20 * (i // 16))
        weights.append(np.ones(8))
        starts.append(starts[-1] + 8)
    search = ranked_search.Search(np.array(starts), np.concatenate(columns).astype(np.int32), np.concatenate(weights), 3, np.zeros(64))
    best = ranked_search.Best(64, 3, search.floor)
    docs = [np.sort(chance.choice(20, 5, replace=False)) + 1 + 20 * (i % 4) for i in range(512)]
    values = [chance.integers(1, 1000, 5) for _ in docs]
    computed, pairs = search.search(best, np.arange(512), np.arange(513) * 5, np.concatenate(docs).astype(np.int32), np.concatenate(values))
    assert pairs == 512 * 64 and computed < pairs / 3
    dense, rows = search.dense(np.arange(81)), np.zeros((512, 81))
    for d, (places, v) in enumerate(zip(docs, values)):
        rows[d, places] = v
    for i, scores in enumerate(dense @ rows.T):
        want = sorted((-s, d) for d, s in enumerate(scores) if s > 0)[:3]
        assert list(zip(-best.scores[i], best.docs[i])) == want


# whitening


def vectors(seed, n, size):
    chance = np.random.default_rng(seed)
    return (chance.standard_normal((n, size)) @ (chance.standard_normal((size, size)) * np.linspace(0.2, 2, size))).astype(np.float32)


def exact_spread(matrix):
    x = np.floor(64 * matrix.astype(np.float64)).astype(np.int64) + 1_000_000
    n, sums = len(x), [int(s) for s in x.sum(0)]
    gaps = n * x - np.array(sums)
    covariance = [[float(Fraction(int((gaps[:, i].astype(object) * gaps[:, j]).sum()), n**3)) for j in range(x.shape[1])] for i in range(x.shape[1])]
    return x, n, sums, np.array(covariance), (gaps * gaps).sum(1)


@pytest.mark.parametrize("size", [1, 3, 40])
def test_whitening_against_dense_eigenvectors(spark, size):
    matrix = vectors(size, 300, size)
    rows = [(i, [float(v) for v in row], 0, "r", "c") for i, row in enumerate(matrix)]
    bad = [(900, None, 0, "r", "c"), (901, [1.0] * (size - 1) + [None], 0, "r", "c"), (902, [float("nan")] + [1.0] * (size - 1), 0, "r", "c")]
    bad += [(903, [float("-inf")] + [0.0] * (size - 1), 0, "r", "c"), (904, [], 0, "r", "c"), (905, [0.5] * (size + 1), 0, "r", "c")]
    rows += [(None, rows[0][1], None, None, None), rows[1]]
    matrix = np.vstack([matrix, matrix[:2]])
    got = queries.op12(spark.createDataFrame(rows + bad, VECTORS).repartition(4)).collect()
    x, n, sums, covariance, deviation = exact_spread(matrix)
    found = min(size, 32)
    assert len(got) == n * found and {r["n"] for r in got} == {n}
    assert Counter(r["deviation"] for r in got) == Counter({int(d): found * c for d, c in Counter(deviation.tolist()).items()})
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1], axes[:, ::-1]
    want = (x - np.array(sums) / n) @ axes / np.sqrt(values)
    for i in (0, 5, 299):
        mine = {r["component"]: r for r in got if r["vec_id"] == i}
        assert sorted(mine) == list(range(1, found + 1))
        for k in range(found):
            assert abs(abs(mine[k + 1]["whitened"]) - abs(want[i, k])) < 1e-8 * max(1, abs(want[i, k]))
            assert abs(mine[k + 1]["explained"] - values[k] / np.trace(covariance)) < 1e-10
    assert len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_without_spread(spark):
    assert queries.op12(spark.createDataFrame([], VECTORS)).collect() == []
    same = spark.createDataFrame([(i, [0.25, 1.0], 0, "r", "c") for i in range(5)], VECTORS)
    assert queries.op12(same).collect() == []
    line = spark.createDataFrame([(i, [float(i), -2.0 * i, 7.0], 0, "r", "c") for i in range(9)], VECTORS)
    got = queries.op12(line).collect()
    assert {r["component"] for r in got} == {1} and got[0]["identity_error"] < 1e-12 and abs(got[0]["explained"] - 1) < 1e-12


def test_spectrum_slicing_of_equal_and_close_values():
    chance = np.random.default_rng(3)
    axes, _ = np.linalg.qr(chance.standard_normal((40, 40)))
    true = np.array([5.0] * 10 + [4.999999999] * 5 + [1.0] * 20 + [0.0] * 5)
    matrix = axes @ np.diag(true) @ axes.T
    values, rows = whitening.leading((matrix + matrix.T) / 2, 40)
    assert len(values) == 35 and np.abs(values - true[:35]).max() < 1e-12
    assert np.abs(rows @ rows.T - np.eye(35)).max() < 1e-13 and np.abs(rows @ matrix - values[:, None] * rows).max() < 1e-12


@pytest.mark.parametrize("seed", range(20))
def test_inertia_counts_signs(seed):
    chance = np.random.default_rng(seed)
    matrix = chance.standard_normal((7, 7))
    matrix = matrix + matrix.T
    matrix[np.diag_indices(7)] *= seed % 2  # zero diagonals need pivots of two
    values = np.linalg.eigvalsh(matrix)
    assert whitening.inertia(matrix) == ((values > 0).sum(), 0, (values < 0).sum())


# toxicity


def distance(a, b):
    """Insertions, deletions, other letters and swapped neighbours."""
    rows = [list(range(len(b) + 1))]
    for i, x in enumerate(a, 1):
        rows.append([i])
        for j, y in enumerate(b, 1):
            best = min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y))
            if i > 1 and j > 1 and x == b[j - 2] and a[i - 2] == y:
                best = min(best, rows[i - 2][j - 2] + 1)
            rows[i].append(best)
    return rows[-1][-1]


def test_automaton_against_edit_distances():
    chance = random.Random(4)
    terms = {"".join(chance.choices("abc", k=chance.randrange(3, 8))) + "$": chance.random() + 1 for _ in range(40)}
    automaton = toxicity.Automaton(terms)
    for _ in range(4000):
        word = "".join(chance.choices("abcd", k=chance.randrange(1, 9)))
        near = [t for t in terms if len(t) > toxicity.SPELLED and distance(word, t[:-1]) == 1]
        want = (word + "$", 0) if word + "$" in terms else (max(near, key=lambda t: (terms[t], t)), 1) if near else None
        assert automaton.find(word) == want, word


def test_stems_spellings_and_quotations():
    lexicon = toxicity.Lexicon({"idiot$": 6.0, "blorg": 5.0, "moron$": 6.0}, {"oron": -1.0})
    assert lexicon.hit("IDIOT") == ("idiot$", 6.0, 0) and lexicon.hit("blorgish") == ("blorg", 5.0, 0)
    for word in ("idoit", "idio", "idiiot", "1diot", "id*ot", "idiooooot"):
        assert lexicon.hit(word) and lexicon.hit(word)[2] == 1, word
    assert lexicon.hit("oron") is None and lexicon.hit("173") is None and lexicon.hit("blurgish") is None
    plain = lexicon.features("You are an idiot and a moron, go away")
    quote = lexicon.features('The review said "an idiot and a moron" about nobody')
    assert plain[3] == 0 and quote[3] == 2 and plain[0][1] > quote[0][1] and plain[0][3] < quote[0][3]
    long = lexicon.features("calm words " * 100_000 + "idiot")
    assert long[1] == 1


def toxic_rows(n, seed):
    chance = random.Random(seed)
    calm = [a + b for a in ("the", "wan", "sol", "mer", "tin", "ka") for b in ("er", "ing", "a", "ost", "um")]
    stem = ["grumb" + e for e in ("el", "osa", "ix", "ant", "u", "ebo")]
    rows, labels = [], []
    for i in range(n):
        words = chance.choices(calm, k=chance.randrange(20, 80))
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(chance.randrange(len(words)), chance.choice(["idiot", "scumbel", *stem]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_toxicity_on_held_out_rows(spark):
    rows, labels = toxic_rows(600, 5)
    more = [(1000, None), (1001, ""), (None, rows[0][1]), (0, rows[0][1]), (1002, rows[1][1] + " idoit you 1diot, scumbal"), (1003, "word " * 60_000)]
    odd = [(None, 1), (7, None), (9, 3), (11, 0), (11, 1), (5, labels[5][1])]
    docs = spark.createDataFrame([document(*r) for r in rows + more], DOCS).repartition(3)
    marks = spark.createDataFrame(labels + odd, "doc_id long, toxic int")
    got = toxicity.scored(docs, marks).collect()
    assert len(got) == len(rows) + len(more) and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)
    true = dict(labels)
    held = [r for r in got if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 1000]
    assert len(held) > 80 and sum(r["predicted"] == true[r["doc_id"]] for r in held) >= 0.98 * len(held)
    by_id = {r["doc_id"]: r for r in got}
    assert by_id[1002]["predicted"] == 1 and by_id[1002]["n_misspelled"] >= 2
    assert by_id[1000]["predicted"] == by_id[1001]["predicted"] == by_id[1003]["predicted"] == 0
    assert by_id[None]["score"] == by_id[0]["score"] and by_id[None]["held_out"]


def test_toxicity_without_labels(spark):
    docs = spark.createDataFrame([document(1, "You pathetic idiot, you moron"), document(2, "A calm day"), document(3, None)], DOCS)
    nothing = spark.createDataFrame([], "doc_id long, toxic int")
    got = {r["doc_id"]: r["predicted"] for r in queries.op11(docs, nothing).collect()}
    assert got == {1: 1, 2: 0, 3: 0}
    assert queries.op11(docs.limit(0), nothing).collect() == []


def test_regression_reaches_its_optimum(spark):
    chance = np.random.default_rng(6)
    x = chance.random((400, len(toxicity.FEATURES)))
    y = (x[:, 0] + 0.3 * chance.standard_normal(400) > 0.5).astype(int)
    rows = spark.createDataFrame([(int(t), *map(float, r)) for t, r in zip(y, x)], "toxic int, " + ", ".join(f"{f} double" for f in toxicity.FEATURES))
    weights = np.array(toxicity.fitted(rows))
    full = np.c_[np.ones(400), x]
    gradient = full.T @ (1 / (1 + np.exp(-full @ weights)) - y) + toxicity.RIDGE * (weights - np.array(toxicity.PRIOR))
    assert np.abs(gradient).max() < 1e-2
