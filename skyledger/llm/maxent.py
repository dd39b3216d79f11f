"""A class-factored maximum-entropy language model over hashed n-gram and skip features."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import text_of, written
from skyledger.llm.quality import bucket_of
from skyledger.llm.words import in_chunks

CLASSES = 256
#: The most frequent words have classes of their own; class 0 is the end of a text.
OWN = 127
#: Words whose counts every task holds. Counts of all others are joined.
HEAD = 1 << 17
#: Rows of the hashed table for pairs of preceding classes.
PAIRS = 4096
ROWS = 1 + 2 * CLASSES + PAIRS
END = b""
#: Distinct keys that a task counts before it hands them on.
HELD = 2_000_000


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 1


def tokens(text: str) -> list[bytes]:
    """Words with A-Z lower-cased; bytes split at just the six blanks that separate words."""
    return text.encode("utf-8", "surrogatepass").lower().split()


def form_class(word: bytes) -> int:
    """The class of a word without a class of its own, by its ending: no vocabulary is needed."""
    return OWN + 1 + zlib.crc32(word[-2:]) % (CLASSES - OWN - 1)


def pair_row(older: np.ndarray, newer: np.ndarray) -> np.ndarray:
    mixed = (older.astype(np.uint64) * np.uint64(CLASSES) + newer.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (mixed >> np.uint64(40)).astype(np.int64) % PAIRS


def feature_rows(older: np.ndarray, newer: np.ndarray) -> list[np.ndarray]:
    """Rows of the weight table that a history of two classes uses: none, the last, the one before it, both."""
    return [np.zeros(len(older), dtype=np.int64), 1 + newer, 1 + CLASSES + older, 1 + 2 * CLASSES + pair_row(older, newer)]


def log_softmax(weights: np.ndarray, older: np.ndarray, newer: np.ndarray) -> np.ndarray:
    logits = sum(weights[rows] for rows in feature_rows(older, newer))
    logits -= logits.max(1, keepdims=True)
    return logits - np.log(np.exp(logits).sum(1, keepdims=True))


class Words:
    """Classes of the words of a chunk."""

    def __init__(self, own: list[bytes]) -> None:
        self.own = {word: i + 1 for i, word in enumerate(own)}

    def chunk(self, texts: list[str]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """Distinct words, the end first; all tokens as places in that list; how many tokens each text has."""
        place: dict[bytes, int] = {END: 0}
        codes, sizes = [], []
        for text in texts:
            found = [place.setdefault(word, len(place)) for word in tokens(text)]
            found.append(0)
            codes.append(np.array(found, dtype=np.int64))
            sizes.append(len(found))
        return list(place), np.concatenate(codes), np.array(sizes)

    def classes(self, words: list[bytes]) -> np.ndarray:
        own = self.own
        return np.array([0 if w == END else own.get(w) or form_class(w) for w in words], dtype=np.int64)


def histories(classes: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two classes before each token; ends stand before a text's first word."""
    newer, older = np.r_[0, classes[:-1]], np.r_[0, 0, classes[:-2]][: len(classes)]
    starts = np.cumsum(sizes) - sizes
    newer[starts] = 0
    older[starts] = 0
    seconds = starts[sizes > 1] + 1
    older[seconds] = 0
    return older, newer


def _counted(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: Counter[bytes] = Counter()
        for batch in batches:
            for text in batch["body"]:
                held.update(tokens(text))
                held[END] += 1
                if len(held) > HELD:
                    yield pd.DataFrame({"word": list(held), "c": list(held.values())})
                    held.clear()
        if held:
            yield pd.DataFrame({"word": list(held), "c": list(held.values())})

    return texts.mapInPandas(run, "word binary, c long").groupBy("word").agg(F.sum("c").alias("c"))


def _transitions(texts: DataFrame, own: list[bytes]) -> DataFrame:
    """history (older * CLASSES + newer), class and how often it follows, over all texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Words(own)
        keys, times = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)

        def frame() -> pd.DataFrame:
            return pd.DataFrame({"history": keys // CLASSES, "class": keys % CLASSES, "n": times})

        for batch in batches:
            for chunk in in_chunks(batch["body"]):
                names, codes, sizes = words.chunk(chunk)
                classes = words.classes(names)[codes]
                older, newer = histories(classes, sizes)
                new, n = np.unique((older * CLASSES + newer) * CLASSES + classes, return_counts=True)
                keys, where = np.unique(np.r_[keys, new], return_inverse=True)
                times = np.bincount(where, weights=np.r_[times, n]).astype(np.int64)
                if len(keys) > HELD:
                    yield frame()
                    keys, times = keys[:0], times[:0]
        yield frame()

    return texts.mapInPandas(run, "history long, class long, n long").groupBy("history", "class").agg(F.sum("n").alias("n"))


def _expected(transitions: DataFrame, weights: np.ndarray | None) -> np.ndarray:
    """Sums over the whole corpus for each weight: observed counts without ``weights``, else what they expect.

    A task holds whole histories; it sends one row for each row of the weight table that
    its histories use, and the rows are summed in Spark. The driver gets the table's size.
    """
    model = transitions.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            history, where = np.unique(batch["history"].to_numpy(), return_inverse=True)
            counts = np.zeros((len(history), CLASSES))
            np.add.at(counts, (where, batch["class"].to_numpy()), batch["n"].to_numpy())
            older, newer = history // CLASSES, history % CLASSES
            if model.value is not None:
                # a history cut by a batch border is expected in parts that add up
                counts = np.exp(log_softmax(model.value, older, newer)) * counts.sum(1, keepdims=True)
            for rows in feature_rows(older, newer):
                order = np.argsort(rows, kind="stable")
                first = np.flatnonzero(np.r_[True, rows[order][1:] != rows[order][:-1]])
                for row, total in zip(rows[order][first].tolist(), np.add.reduceat(counts[order], first)):
                    sums[row] = sums[row] + total if row in sums else total
        yield pd.DataFrame({"row": list(sums), "sums": [s.astype(np.float32).tobytes() for s in sums.values()]})

    def add(rows: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(s, np.float32) for s in rows["sums"]], axis=0, dtype=np.float64)
        return pd.DataFrame({"row": rows["row"].iloc[:1], "sums": [total.astype(np.float32).tobytes()]})

    kind = "row long, sums binary"
    out = np.zeros((ROWS, CLASSES))
    for row, sums in transitions.mapInPandas(run, kind).groupBy("row").applyInPandas(add, kind).collect():
        out[row] = np.frombuffer(bytes(sums), np.float32)
    model.unpersist()
    return out


def train(transitions: DataFrame, rounds: int = 8, rate: float = 0.4, prior: float = 2.0) -> np.ndarray:
    """Weights, ROWS by CLASSES, by full gradients over all transitions.

    The gradient of the log-likelihood is observed less expected counts. Each weight
    moves by its part of it over its expected count, with bounded steps, which is the
    first-order form of iterative scaling; ``prior`` holds rarely seen weights near zero.
    """
    observed = _expected(transitions, None)
    weights = np.zeros((ROWS, CLASSES))
    weights[0] = np.log((observed[0] + 0.5) / (observed[0].sum() + 0.5 * CLASSES))
    for _ in range(rounds):
        gradient = observed - (expected := _expected(transitions, weights)) - prior * weights * (np.arange(ROWS) > 0)[:, None]
        weights += rate * np.clip(gradient / (expected + prior), -1.0, 3.0)
    return weights


def _scored(docs: DataFrame, own: list[bytes], head: dict[bytes, int], weights: np.ndarray, below: np.ndarray) -> DataFrame:
    """Two kinds of rows: of each document (word null) its sums over known words, and its other words with their counts."""
    context = docs.sparkSession.sparkContext
    shared = context.broadcast((own, head, weights, below))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, head, weights, below = shared.value
        words = Words(own)
        every = np.arange(CLASSES * CLASSES)
        norm = np.zeros(len(every))
        for some in np.split(every, 64):  # the normaliser of every history, once a task
            logits = sum(weights[rows] for rows in feature_rows(some // CLASSES, some % CLASSES))
            top = logits.max(1)
            norm[some] = top + np.log(np.exp(logits - top[:, None]).sum(1))
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            at = 0
            for chunk in in_chunks(batch["body"]):
                names, codes, sizes = words.chunk(chunk)
                counts = np.array([head.get(w, -1) for w in names], dtype=np.int64)
                classes = words.classes(names)[codes]
                older, newer = histories(classes, sizes)
                logp = sum(weights[rows, classes] for rows in feature_rows(older, newer)) - norm[older * CLASSES + newer]
                known, count = counts[codes] >= 0, counts[codes]
                share = np.where(known, np.log10(np.maximum(count, 0) + 0.5), 0.0)
                starts = np.cumsum(sizes) - sizes
                total = lambda values: np.add.reduceat(values, starts)
                n = len(chunk)
                ids = uid + np.arange(n)
                yield pd.DataFrame(
                    {
                        "uid": ids, "doc_id": batch["doc_id"].iloc[at : at + n].astype("Int64"), "word": None, "n": sizes,
                        "n_known": total((known & (count > 0)).astype(np.int64)),
                        "share": total(share), "model": total(logp / np.log(10) - below[classes]),
                    }
                )
                rest = np.flatnonzero(~known)
                if len(rest):
                    doc = np.repeat(np.arange(n), sizes)[rest]
                    key, times = np.unique(doc * len(names) + codes[rest], return_counts=True)
                    yield pd.DataFrame(
                        {"uid": ids[key // len(names)], "doc_id": None, "word": [names[k] for k in key % len(names)], "n": times, "n_known": 0, "share": 0.0, "model": 0.0}
                    )
                uid += n
                at += n

    return docs.mapInPandas(run, "uid long, doc_id long, word binary, n long, n_known long, share double, model double")


def scored(docs: DataFrame, rounds: int = 8) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of each row of (doc_id, text).

    Training rows are those whose crc32(doc_id as text) mod 5 is not 1; a null id counts
    as empty text. Null and empty texts have one token, their end. Rows that repeat an
    id are rows of their own. Without any training row every count is 0.

    p(word | history) = p(class | two classes before it) * p(word | class). The first
    factor is a maximum-entropy model with weights for the class alone, after the last
    class, after the one before it (skip) and after both (hashed), trained on the counts
    of all class triples of all training texts. The second is (c + 0.5) / (N + 0.5(V + 1))
    within the class. Classes: the end, the most frequent words, and endings.

    Counts of the HEAD most frequent words go to every task, a bound that does not grow;
    a document's other words are joined with the counts of all words, so that no word of
    the vocabulary is left out. No such word is hot: about HEAD words are more frequent.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    training = docs.where(~held_out(F.col("doc_id"))).select("body")
    counts = written(_counted(training), "counts")
    train_tokens, vocabulary = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()

    # counts by their leading binary digits, a few hundred rows, tell from which count on all words fit
    levels = counts.groupBy(F.expr(bucket_of("c")).alias("level")).agg(F.count("*").alias("n")).orderBy(F.desc("level")).collect()
    fitting = [r["level"] for r, total in zip(levels, np.cumsum([r["n"] for r in levels])) if total <= HEAD]
    head = [(bytes(r["word"]), r["c"]) for r in counts.where(F.col("c") >= (fitting[-1] if fitting else 1 << 62)).collect()]
    head.sort(key=lambda pair: (-pair[1], pair[0]))
    own = [word for word, _ in head if word != END][:OWN]
    head = dict(head)
    end = counts.where(F.length("word") == 0).first()  # END may be rarer than the words of the head
    head[END] = end["c"] if end else 0

    @F.pandas_udf("int")
    def class_of(word: pd.Series) -> pd.Series:
        return pd.Series(Words(own).classes([bytes(w) for w in word]), dtype="int32")

    in_class = np.zeros((CLASSES, 2))
    for name, n, distinct in counts.groupBy(class_of("word").alias("class")).agg(F.sum("c"), F.count("*")).collect():
        in_class[name] = n, distinct
    below = np.log10(in_class[:, 0] + 0.5 * (in_class[:, 1] + 1))

    transitions = written(_transitions(training, own).repartition("history").sortWithinPartitions("history"), "transitions")
    weights = train(transitions, rounds)

    rows = written(_scored(docs, own, head, weights, below), "scored")
    c = F.coalesce(F.col("c"), F.lit(0))
    rest = rows.where("word IS NOT NULL").select("uid", "word", "n").join(counts, "word", "left")
    rest = rest.groupBy("uid").agg(F.sum(F.col("n") * F.log10(c + 0.5)).alias("rest"), F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"))
    full = rows.where("word IS NULL").drop("word").join(rest, "uid", "left")
    share = F.col("share") + F.coalesce("rest", F.lit(0.0))
    all_below = float(np.log10(train_tokens + 0.5 * (vocabulary + 1)))
    return full.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("n").alias("n_tokens"),
        (F.col("n_known") + F.coalesce("more", F.lit(0))).alias("n_known"),
        F.lit(int(train_tokens)).cast("long").alias("train_tokens"),
        (share - F.col("n") * all_below).alias("base_score"),
        (share + F.col("model")).alias("score"),
    )
