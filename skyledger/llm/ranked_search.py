"""The best documents for each of many texts, by dual-tree search over whole texts."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import written

#: Maximal runs of anything but ASCII signs and blanks; of UTF-8 bytes, since A-Z are lower-cased alone.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Items of a block, and bytes of their texts: what one pass over the documents holds in each task.
BLOCK_ITEMS, BLOCK_BYTES = 512, 1 << 20
#: Children of a node in both trees.
FAN_ITEMS, FAN_DOCS = 8, 16
#: Numbers in a batch of documents times the terms they use.
CELLS = 1 << 21
#: Scores up to here are whole numbers in a double.
EXACT = float(1 << 53)
#: One document in so many gives the first lower bounds of the kth scores.
PILOT = 64


def terms(text: str | None) -> list[bytes]:
    return TERM.findall((text or "").encode("utf-8", "surrogatepass").lower())


def length_part(n, documents: int, total: int):
    """m, which grows with a document's length over the mean."""
    return 75 + (25 * n * documents) // total


def impact(tf, m):
    """What a term's occurrences count for: at most 1,000,000 each."""
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


def weight(documents: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * df + 1)))


def arranged(matrix: np.ndarray) -> np.ndarray:
    """An order of rows in which neighbours share coordinates: halved again and again around two distant rows."""
    unit = matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-300)
    out: list[int] = []
    stack = [np.arange(len(matrix))]
    while stack:
        part = stack.pop()
        if len(part) <= FAN_ITEMS:
            out += part.tolist()
            continue
        rows = unit[part]
        one = rows[int(np.argmin(rows @ rows.mean(0)))]
        other = rows[int(np.argmin(rows @ one))]
        order = np.argsort(rows @ one - rows @ other, kind="stable")
        stack += [part[order[len(order) // 2 :]], part[order[: len(order) // 2]]]
    return np.array(out, dtype=np.int64)


def levels(rows: np.ndarray, fan: int) -> list[np.ndarray]:
    """Coordinate maxima: the rows, then of each ``fan`` neighbours, up to one root."""
    out = [rows]
    while len(out[-1]) > 1:
        out.append(np.maximum.reduceat(out[-1], np.arange(0, len(out[-1]), fan), axis=0))
    return out


class Best:
    """The best ``k`` documents of each item so far; ``floor`` holds scores that k documents are known to reach."""

    def __init__(self, items: int, k: int, floor: np.ndarray) -> None:
        self.k, self.weakest = k, np.maximum(floor, 1.0)
        self.scores = [np.empty(0) for _ in range(items)]
        self.docs = [np.empty(0, dtype=np.int64) for _ in range(items)]

    def offer(self, item: int, scores: np.ndarray, docs: np.ndarray) -> None:
        """``docs`` are places in the order of ids, so that equal scores prefer the smaller one."""
        scores, docs = np.r_[self.scores[item], scores], np.r_[self.docs[item], docs]
        order = np.lexsort((docs, -scores))[: self.k]
        self.scores[item], self.docs[item] = scores[order], docs[order]
        if len(order) == self.k:
            self.weakest[item] = max(self.weakest[item], scores[order[-1]])


@dataclass
class Search:
    """Items as a sparse matrix of term weights, in the order of their tree."""

    starts: np.ndarray
    columns: np.ndarray
    weights: np.ndarray
    k: int
    floor: np.ndarray

    def dense(self, used: np.ndarray) -> np.ndarray:
        """Items by the terms ``used`` (sorted)."""
        out = np.zeros((len(self.starts) - 1, len(used)))
        at = np.minimum(np.searchsorted(used, self.columns), max(len(used) - 1, 0))
        here = used[at] == self.columns if len(used) else np.zeros(len(at), dtype=bool)
        rows = np.repeat(np.arange(len(self.starts) - 1), np.diff(self.starts))
        out[rows[here], at[here]] = self.weights[here]
        return out

    def search(self, best: Best, ids: np.ndarray, starts: np.ndarray, columns: np.ndarray, impacts: np.ndarray) -> tuple[int, int]:
        """Offer ``best`` whatever of a batch of documents can be among an item's best; scores computed, and pairs.

        A pair of an item node and a document node is bounded by the product of their
        coordinate maxima. Below the weakest kth score of the node's items, none of its
        pairs can count; scores equal to it go on, because the smaller id wins.
        """
        used = np.unique(columns)
        items = levels(self.dense(used), FAN_ITEMS)
        docs = np.zeros((len(ids), len(used)))
        docs[np.repeat(np.arange(len(ids)), np.diff(starts)), np.searchsorted(used, columns)] = impacts
        # documents lie under the item nodes that they match best
        coarse = items[min(len(items) - 1, 2)]
        fine = items[min(len(items) - 1, 1)]
        order = np.lexsort(((docs @ fine.T).argmax(1), (docs @ coarse.T).argmax(1)))
        docs, ids = docs[order], ids[order]
        trees = levels(docs, FAN_DOCS)
        computed = 0

        def weakest(level: int) -> np.ndarray:
            out = best.weakest
            for _ in range(level):
                out = np.minimum.reduceat(out, np.arange(0, len(out), FAN_ITEMS))
            return out

        # pairs wait as (item level, item nodes, document level, document node); both sides go down together
        waiting = [(len(items) - 1, np.array([0]), len(trees) - 1, 0)]
        while waiting:
            i, nodes, d, node = waiting.pop()
            bounds = items[i][nodes] @ trees[d][node]
            nodes = nodes[bounds >= weakest(i)[nodes]]
            if not len(nodes):
                continue
            if i:
                i -= 1
                nodes = (nodes[:, None] * FAN_ITEMS + np.arange(FAN_ITEMS)).ravel()
                nodes = nodes[nodes < len(items[i])]
            if d > 1:
                first = node * FAN_DOCS
                below = range(first, min(first + FAN_DOCS, len(trees[d - 1])))
                mass = items[i][nodes].max(0) @ trees[d - 1][first : below.stop].T
                waiting += [(i, nodes, d - 1, first + int(c)) for c in np.argsort(mass, kind="stable")]
                continue
            if i:
                waiting.append((i, nodes, d, node))
                continue
            some = slice(node * FAN_DOCS, (node + 1) * FAN_DOCS) if d else slice(0, len(docs))
            scores = items[0][nodes] @ docs[some].T
            computed += scores.size
            good = scores >= best.weakest[nodes][:, None]
            for row in np.flatnonzero(good.any(1)):
                best.offer(int(nodes[row]), scores[row][good[row]], ids[some][good[row]])
        return computed, len(ids) * (len(self.starts) - 1)


def _matched(documents: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n (all terms) and the places and counts of the items' terms, for documents with a term."""
    shared = documents.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = shared.value
        for batch in batches:
            keep, sizes, ends, found, counts = [], [], [0], [], []
            for row, text in enumerate(batch.column("text")):
                every = terms(text.as_py())
                if not every:
                    continue
                tf = Counter(filter(None, map(place.get, every)))
                keep.append(row)
                sizes.append(len(every))
                found.extend(tf.keys())
                counts.extend(tf.values())
                ends.append(len(found))
            lists = pa.array(ends, pa.int32())
            yield pa.record_batch(
                [
                    batch.column("doc_id").take(pa.array(keep, pa.int64())),
                    pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(lists, pa.array(found, pa.int32())),
                    pa.ListArray.from_arrays(lists, pa.array(counts, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return documents.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<long>")


def _searched(matched: DataFrame, search: Search, documents: int, total: int) -> DataFrame:
    """item, doc_id and score: the best documents that each task has for each item."""
    shared = matched.sparkSession.sparkContext.broadcast(search)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = shared.value
        items = len(search.starts) - 1
        best = Best(items, search.k, search.floor)
        # null ids come last among equal scores; the array of ids keeps them apart
        for batch in batches:
            ends = batch.column("terms").offsets.to_numpy() - batch.column("terms").offsets[0].as_py()
            columns = batch.column("terms").flatten().to_numpy()
            tfs = batch.column("tfs").flatten().to_numpy()
            n = batch.column("n").to_numpy()
            ids = batch.column("doc_id").fill_null(np.iinfo(np.int64).max).to_numpy()
            m = length_part(n, documents, total)
            impacts = impact(tfs, np.repeat(m, np.diff(ends)))
            start = 0
            while start < len(n):
                end = start + 1
                width = ends[end] - ends[start]
                while end < len(n) and (end - start + 1) * (width + ends[end + 1] - ends[end]) <= CELLS:
                    width += ends[end + 1] - ends[end]
                    end += 1
                if width:
                    some = slice(ends[start], ends[end])
                    search.search(best, ids[start:end], ends[start : end + 1] - ends[start], columns[some], impacts[some])
                start = end
        rows = np.repeat(np.arange(items), [len(s) for s in best.scores])
        ids = pa.array(np.concatenate([*best.docs, np.empty(0, dtype=np.int64)]))
        ids = pa.compute.if_else(pa.compute.equal(ids, np.iinfo(np.int64).max), pa.scalar(None, pa.int64()), ids)
        scores = np.concatenate([*best.scores, np.empty(0)]).astype(np.int64)
        task = np.full(len(rows), TaskContext.get().partitionId(), dtype=np.int64)
        yield pa.record_batch([pa.array(rows.astype(np.int32)), ids, pa.array(scores), pa.array(task)], ["item", "doc_id", "score", "task"])

    return matched.mapInArrow(run, "item int, doc_id long, score long, task long")


def _first(rows: DataFrame, k: int, *groups: str) -> DataFrame:
    order = Window.partitionBy(*groups).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(documents: DataFrame, texts: list[str], k: int) -> DataFrame:
    """text, rank, doc_id and score for one block of distinct item texts."""
    spark = documents.sparkSession
    kind = "text string, rank int, doc_id long, score long"
    counted = [Counter(terms(text)) for text in texts]
    # place 0 is no term, so that a lookup that finds one is never false
    vocabulary = {term: i + 1 for i, term in enumerate(sorted(set().union(*counted)))}
    matched = written(_matched(documents, vocabulary), "matched")
    documents_with_terms, total = matched.agg(F.count("*"), F.sum("n")).first()
    if not documents_with_terms or not vocabulary:
        return spark.createDataFrame([], kind)
    df = dict(matched.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*")).collect())
    weights = {term: weight(documents_with_terms, df.get(place, 0)) for term, place in vocabulary.items()}
    if max((sum(c * weights[t] for t, c in item.items()) for item in counted), default=0) * 1e6 >= EXACT:
        raise OverflowError("an item is too long for exact scores")

    keys = [np.array(sorted(vocabulary[t] for t in item), dtype=np.int32) for item in counted]
    names = {place: term for term, place in vocabulary.items()}
    values = [np.array([item[names[int(p)]] * weights[names[int(p)]] for p in places], dtype=np.float64) for item, places in zip(counted, keys)]

    def search_of(order: np.ndarray, floor: np.ndarray) -> Search:
        starts = np.r_[0, np.cumsum([len(keys[i]) for i in order])]
        return Search(starts, np.concatenate([keys[i] for i in order]), np.concatenate([values[i] for i in order]), k, floor)

    plain = search_of(np.arange(len(texts)), np.zeros(len(texts)))
    places, times = np.unique(plain.columns, return_counts=True)
    order = arranged(plain.dense(places[times > 1]))  # terms of one item alone tell nothing of neighbours
    search = search_of(order, np.zeros(len(texts)))
    # k documents of a few reach these scores, so the kth best of all reaches them too
    few = matched.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(PILOT)) == 0)
    lower = _first(_searched(few, search, documents_with_terms, total), k, "item").where(F.col("rank") == k)
    for item, score in lower.select("item", "score").collect():
        search.floor[item] = score
    found = _searched(matched, search, documents_with_terms, total)
    found = _first(found.withColumn("salt", F.pmod(F.col("task"), F.lit(64))), k, "item", "salt").drop("rank")
    found = _first(found, k, "item")
    names_of = spark.createDataFrame([(i, texts[int(at)]) for i, at in enumerate(order)], "item int, text string")
    return written(found.join(F.broadcast(names_of), "item").select("text", "rank", "doc_id", "score"), "ranked")


def ranked(documents: DataFrame, items: DataFrame, k: int = 20) -> DataFrame:
    """item_id, rank, doc_id and score: for each row of ``items`` (item_id, text) its k best rows of ``documents`` (doc_id, text).

    Terms, weights and scores are whole numbers as in ``impact``, ``weight`` and
    ``length_part``; counts are over all documents with at least one term. Only scores
    above 0 count, equal ones by ascending doc_id, null ids last. Null texts, and texts
    without a term, have none: such an item has no rows. Documents that repeat an id, or
    all of a row, are rows of their own. Rows of ``items`` with equal texts are searched
    once and each returned, so that an item_id on several rows has several rankings.

    1. Distinct item texts go to every task in blocks of bounded number and bytes; each
       block is one pass over the texts, which leaves the counts of the block's terms,
       and document frequencies from these.
    2. Items form a tree by shared terms, a batch of documents one under the item nodes
       they match best. Nodes hold coordinate maxima. A pair of nodes whose product lies
       below the weakest kth score of its items is dropped with all pairs below it; the
       rest goes down to exact scores. No pair that could be returned is dropped.
    3. Each task has at most k documents per item, merged in two rounds. First kth
       scores come from one document in PILOT; they only bound, all documents are searched.

    Scores are sums of whole numbers in doubles, exact below 2^53; an item so long that
    its score could exceed that raises.
    """
    items = written(items.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL"), "items")
    documents = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    texts = items.select("text").distinct()
    number, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    blocks = max(-(-number // BLOCK_ITEMS), -(-size // BLOCK_BYTES), 1)
    out = None
    for block in range(blocks):
        some = [r["text"] for r in texts.where(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("text").collect()]
        part = _block(documents, some, k)
        out = part if out is None else out.unionByName(part)
    return items.join(out, "text").select("item_id", "rank", "doc_id", "score")
