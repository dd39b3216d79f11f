"""Toxicity of whole texts: a learned lexicon met through Levenshtein automata, weighed by context."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import text_of, written
from skyledger.llm.words import in_chunks, shingle_sets

#: Labelled rows that the classifier is fitted on at most; they are broadcast by id.
FIT_ROWS = 200_000
#: Terms of the learned lexicon at most, those of strongest evidence.
TERMS = 20_000
#: Words that count as terms before anything is learned, with this log-odds; evidence overrides it.
SEEDS = ("bastard", "disgusting", "idiot", "imbecile", "loser", "moron", "pathetic", "scum", "stupid", "worthless")
SEED_ODDS = 4.0
#: A whole word; a stem is followed by any ending.
END = "$"
#: Stems have so many letters; terms of at least SPELLED letters are also found with one error.
STEM = (4, 12)
SPELLED = 5
#: What one error leaves of a term's weight.
MISSPELLED = 0.7
#: Words to either side that make a hit's context.
WINDOW = 8
#: Cached words per worker, and states of an automaton.
REMEMBERED, STATES = 200_000, 100_000
#: Distinct keys that a task counts before it hands them on.
HELD = 500_000

TOKEN = re.compile(r"[@$]?[^\W_]+(?:[@$!*'’][^\W_]+)*")
LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
LONG_RUN = re.compile(r"(.)\1{2,}")
QUOTED = re.compile(r'“[^”]{1,600}”|«[^»]{1,600}»|„[^“”]{1,600}[“”]|"[^"\n]{1,600}"')
#: Who is spoken to, and who only reports, in the languages of the corpus.
ADDRESS = frozenset("you your yours you're u du dich dir ihr euch tu toi te vous tú ti usted ustedes eres".split())
REPORT = frozenset(
    "said says wrote called quote quoted quotes term word words insult slur"
    " sagte sagt schrieb nannte wort zitat dit écrit appelé mot terme citation dijo dice escribió llamó palabra término cita".split()
)
FEATURES = ("strongest", "abuse", "misspelled", "quoted", "window", "length", "density")
#: Weights before labels are seen: the intercept, then one for each feature. Fitting moves them.
PRIOR = (-4.0, 0.8, 0.8, 0.3, -0.3, 0.3, -0.1, 0.2)
RIDGE = 1.0


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def normal(token: str) -> str:
    """Lower case, look-alike signs between letters as letters, runs of three or more letters as two; "" without letters."""
    word = token.lower()
    if not word.isalpha():
        if not any(c.isalpha() for c in word):
            return ""
        word = word.replace("'", "").replace("’", "").translate(LOOKALIKES)
    return LONG_RUN.sub(r"\1\1", word)


def prefixes(word: str) -> Iterator[str]:
    """What a word may be evidence for: itself, and its stems."""
    yield word + END
    for n in range(STEM[0], min(len(word), STEM[1]) + 1):
        yield word[:n]


class Automaton:
    """All words within one error of a trie of terms: a Levenshtein automaton run along the trie.

    A state is the set of (node, errors, awaited letter) that the letters so far can have
    reached: an error is a letter too much, another letter, a letter too few, or two
    letters swapped. States are made when first met and then kept, so that a word costs one
    lookup a letter. Stems are met without error; what follows them is any ending.
    """

    def __init__(self, terms: dict[str, float]) -> None:
        self.children: list[dict[str, int]] = [{}]
        self.whole: dict[int, str] = {}
        self.stems: dict[int, str] = {}
        for term in terms:
            node = 0
            for letter in term.removesuffix(END):
                node = self.children[node].setdefault(letter, len(self.children))
                if node == len(self.children):
                    self.children.append({})
            (self.whole if term.endswith(END) else self.stems)[node] = term
        self.weights = terms
        self._forget()

    def _forget(self) -> None:
        self.numbers: dict[frozenset, int] = {}
        self.states: list[frozenset] = []
        self.ends: list[tuple[str | None, str | None, str | None]] = []
        self.moves: dict[tuple[int, str], int] = {}
        self.dead = self._number(frozenset())
        self.start = self._number(frozenset([(0, 0, "")]))

    def _number(self, state: frozenset) -> int:
        if state not in self.numbers:
            self.numbers[state] = len(self.states)
            self.states.append(state)
            exact = next((node for node, errors, _ in state if not errors), None)
            near = [self.whole[n] for node, e, awaited in state if not awaited for n in self._closing(node, e) if n in self.whole]
            near = [t for t in near if len(t) > SPELLED]
            best = max(near, key=lambda t: (self.weights[t], t), default=None)
            self.ends.append((self.whole.get(exact), self.stems.get(exact), best))
        return self.numbers[state]

    def _closing(self, node: int, errors: int) -> list[int]:
        """Where a word may end: here, or with the term's last letter left out."""
        return [node] if errors else [node, *self.children[node].values()]

    def _move(self, number: int, letter: str) -> int:
        out: set[tuple[int, int, str]] = set()
        for node, errors, awaited in self.states[number]:
            if awaited:
                if awaited == letter:
                    out.add((node, errors, ""))
                continue
            below = self.children[node]
            if letter in below:
                out.add((below[letter], errors, ""))
            if not errors:
                out.add((node, 1, ""))
                for other, child in below.items():
                    if other != letter:
                        out.add((child, 1, ""))
                        if letter in self.children[child]:
                            out.add((self.children[child][letter], 1, other))
                    if letter in self.children[child]:
                        out.add((self.children[child][letter], 1, ""))
        exact = {(node, awaited) for node, errors, awaited in out if not errors}
        return self._number(frozenset(s for s in out if not s[1] or (s[0], s[2]) not in exact))

    def find(self, word: str) -> tuple[str, int] | None:
        """The term that a word is, or the longest stem it begins with, or a term one error away: (term, errors)."""
        if len(self.states) > STATES:
            self._forget()
        state, stem = self.start, None
        for letter in word:
            key = (state, letter)
            state = self.moves.get(key, -1)
            if state < 0:
                state = self.moves[key] = self._move(*key)
            if state == self.dead:
                break
            stem = self.ends[state][1] or stem
        whole, _, near = self.ends[state]
        if whole:
            return whole, 0
        if stem:
            return stem, 0
        return (near, 1) if near else None


@dataclass
class Lexicon:
    """Terms with their log-odds, and words that are near a term but have evidence of their own."""

    terms: dict[str, float]
    known: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.automaton, self.cache = Automaton(self.terms), {}

    def hit(self, token: str) -> tuple[str, float, int] | None:
        """(term, weight, errors) of a token, None if it is nothing of the kind."""
        if token in self.cache:
            return self.cache[token]
        if len(self.cache) >= REMEMBERED:
            self.cache.clear()
        word, out = normal(token), None
        found = self.automaton.find(word) if word else None
        if found:
            term, errors = found
            weight = self.terms[term] if not errors else self.known.get(word, MISSPELLED * self.terms[term])
            # look-alike signs are errors as well
            errors = errors or int(any(c in token for c in "013457@$!*"))
            out = (term, weight, errors) if weight > 0 else None
        self.cache[token] = out
        return out

    def features(self, text: str) -> tuple[list[float], int, int, int]:
        """The features of a text, and how many hits it has: all, misspelled, quoted."""
        found = [(place, token) for place, token in enumerate(TOKEN.findall(text)) if self.hit(token)]
        size = text.count(" ") + text.count("\n") + 1
        if not found:
            return [0.0, 0.0, 0.0, 0.0, 0.0, math.log1p(size), 0.0], 0, 0, 0
        spans = list(TOKEN.finditer(text))
        quotes = [m.span() for m in QUOTED.finditer(text)]
        abuse: dict[str, float] = {}
        misspelled: dict[str, float] = {}
        in_quotes: dict[str, float] = {}
        places = np.array([place for place, _ in found])
        weights, quoted, at = np.zeros(len(found)), 0, 0
        for i, (place, token) in enumerate(found):
            term, weight, errors = self.hit(token)
            start = spans[place].start()
            while at < len(quotes) and quotes[at][1] <= start:
                at += 1
            quote = at < len(quotes) and quotes[at][0] <= start
            near = [spans[k].group().lower() for k in range(max(place - WINDOW, 0), min(place + WINDOW + 1, len(spans)))]
            before = [spans[k].group().lower() for k in range(max(place - 4, 0), place)]
            others = np.searchsorted(places, place + WINDOW, "right") - np.searchsorted(places, place - WINDOW) - 1
            tone = 1.5 + min(others, 2) + any(w in ADDRESS for w in near) - 3 * quote - 1.5 * any(w in REPORT for w in before)
            share = 1 / (1 + math.exp(-tone))
            quoted += share < 0.5
            weights[i] = weight * share
            abuse[token] = max(abuse.get(token, 0.0), weight * share)
            in_quotes[term] = max(in_quotes.get(term, 0.0), weight * (1 - share))
            if errors:
                misspelled[token] = max(misspelled.get(token, 0.0), weight * share)
        sums = np.r_[0.0, np.cumsum(weights)]
        window = float((sums[np.searchsorted(places, places + 2 * WINDOW, "right")] - sums[:-1]).max())
        values = [
            max(abuse.values()),
            math.log1p(sum(abuse.values())),
            math.log1p(sum(misspelled.values())),
            math.log1p(sum(in_quotes.values())),
            math.log1p(window),
            math.log1p(size),
            math.log1p(100 * len(found) / size),
        ]
        return values, len(found), sum(self.hit(t)[2] > 0 for _, t in found), quoted


def _labelled(labels: DataFrame) -> DataFrame:
    """doc_id and toxic of at most FIT_ROWS training rows, chosen by a hash; ids with both labels are left out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    rows = rows.where(F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("most")).where("toxic = most")
    return written(rows.select("doc_id", "toxic").orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS), "labels")


def _speakers(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, toxic and fold of labelled rows; of copies and near copies, one speaks.

    Copies share the smallest hash of their five-word shingles, near copies mostly.
    They would make every word of a text look like evidence, and would lie in both folds.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            least = [int(s[:1].view(np.int64)[0]) if len(s) else 0 for chunk in in_chunks(batch["body"]) for s in shingle_sets(chunk, 5)]
            yield batch[["doc_id", "toxic"]].assign(least=least)

    rows = docs.join(F.broadcast(labels), "doc_id").select("doc_id", "toxic", "body").mapInPandas(run, "doc_id long, toxic int, least long")
    rows = rows.groupBy("least").agg(F.min(F.struct("doc_id", "toxic")).alias("one"))
    rows = rows.select("one.*", (F.pmod(F.xxhash64("least"), F.lit(3)) == 0).alias("weighing"))
    return written(rows.groupBy("doc_id", "toxic").agg(F.min("weighing").alias("weighing")), "speakers")


def _evidence(docs: DataFrame, speakers: DataFrame) -> DataFrame:
    """key, toxic and clean: in how many texts of either label a word or stem occurs."""

    def frame(held: tuple[Counter, Counter]) -> pd.DataFrame:
        keys = list(held[0] | held[1])
        return pd.DataFrame({"key": keys, "clean": [held[0][k] for k in keys], "toxic": [held[1][k] for k in keys]})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: tuple[Counter, Counter] = Counter(), Counter()
        for batch in batches:
            for text, toxic in zip(batch["body"], batch["toxic"]):
                words = {normal(token) for token in set(TOKEN.findall(text))} - {""}
                held[toxic].update({key for word in words for key in prefixes(word)})
                if len(held[0]) + len(held[1]) > HELD:
                    yield frame(held)
                    held = Counter(), Counter()
        if held[0] or held[1]:
            yield frame(held)

    rows = docs.join(F.broadcast(speakers.where("NOT weighing")), "doc_id").select("body", "toxic")
    rows = rows.mapInPandas(run, "key string, clean long, toxic long")
    return written(rows.groupBy("key").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "evidence")


def log_odds(toxic: float, clean: float, all_toxic: int, all_clean: int) -> float:
    return math.log((toxic + 0.5) / (all_toxic + 1)) - math.log((clean + 0.5) / (all_clean + 1))


def closed(counts: dict[str, tuple[int, int]]) -> dict[str, tuple[int, int]]:
    """Keys without those that one longer key stands for in every text."""
    out = dict(counts)
    for key, numbers in counts.items():
        shorter = key[:-1]
        if len(shorter) >= STEM[0] and counts.get(shorter) == numbers:
            out.pop(shorter, None)
    return out


def learn(docs: DataFrame, speakers: DataFrame) -> Lexicon:
    """The lexicon of the learning fold: words and stems much more frequent in toxic texts, by evidence.

    A term is in 3 toxic texts at least, 4.5 times as likely in these, with a likelihood ratio
    (G squared) of 15 or more. Words near a term that clean texts use are known: they
    weigh by their own evidence and are no misspellings.
    """
    evidence = _evidence(docs, speakers)
    sizes = dict(speakers.where("NOT weighing").groupBy("toxic").agg(F.count("*")).collect())
    bad, good = sizes.get(1, 0), sizes.get(0, 0)
    t, c = F.col("toxic"), F.col("clean")
    part = lambda n, of: F.when(n > 0, n * F.log(n * (bad + good) / ((t + c) * of))).otherwise(0.0)
    strength = 2 * (part(t, max(bad, 1)) + part(c, max(good, 1)))
    odds = F.log((t + 0.5) / (bad + 1)) - F.log((c + 0.5) / (good + 1))
    strong = evidence.where((t >= 3) & (odds >= 1.5)).withColumn("strength", strength).where("strength >= 15")
    rows = strong.orderBy(F.desc("strength"), "key").limit(TERMS).collect()
    counts = closed({r["key"]: (r["toxic"], r["clean"]) for r in rows})
    terms = {key: log_odds(*numbers, bad, good) for key, numbers in counts.items()}
    seeds = evidence.where(F.col("key").isin([s + END for s in SEEDS])).collect()
    seen = {r["key"]: log_odds(r["toxic"], r["clean"], bad, good) for r in seeds}
    for seed in SEEDS:
        terms.setdefault(seed + END, seen.get(seed + END, SEED_ODDS))
    terms = {key: weight for key, weight in sorted(terms.items()) if weight > 0}

    def near(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        automaton = Automaton(terms)
        for batch in batches:
            found = [automaton.find(key.removesuffix(END)) for key in batch["key"]]
            yield batch[[bool(f) and f[1] > 0 for f in found]]

    # words that a clean text uses, near a term: bounded by the words of the fitted rows
    words = evidence.where(F.col("key").endswith(END) & (F.col("clean") > 0)).select("key", "clean", "toxic")
    known = words.mapInPandas(near, "key string, clean long, toxic long").collect()
    return Lexicon(terms, {r["key"].removesuffix(END): log_odds(r["toxic"], r["clean"], bad, good) for r in known})


def _measured(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, hits and features of every row."""
    shared = docs.sparkSession.sparkContext.broadcast((lexicon.terms, lexicon.known))
    columns = ["n_hits", "n_misspelled", "n_quoted"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lexicon = Lexicon(*shared.value)
        for batch in batches:
            if not len(batch):
                continue
            values, *hits = zip(*map(lexicon.features, batch["body"]))
            out = pd.DataFrame(np.array(values, dtype=float).reshape(-1, len(FEATURES)), columns=list(FEATURES))
            out.insert(0, "doc_id", batch["doc_id"].astype("Int64").to_numpy())
            yield out.assign(**dict(zip(columns, hits)))

    kind = ", ".join([f"{name} double" for name in FEATURES] + [f"{name} long" for name in columns])
    return docs.select("doc_id", "body").mapInPandas(run, f"doc_id long, {kind}")


def _logit(weights: Sequence[float]) -> Column:
    return sum((F.col(f) * w for f, w in zip(FEATURES, weights[1:])), F.lit(float(weights[0])))


def fitted(rows: DataFrame, rounds: int = 50, tolerance: float = 1e-6) -> list[float]:
    """Weights of a logistic regression of ``toxic`` on the features, held near PRIOR by a ridge.

    Newton rounds; each sums gradient and curvature over all rows in one aggregation. A
    step that does not lower the loss is halved. Raises when it does not converge.
    """
    size = len(FEATURES) + 1
    prior = np.array(PRIOR)
    columns = [F.lit(1.0), *map(F.col, FEATURES)]

    def sums(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        z = _logit([float(w) for w in weights])
        p = 1 / (1 + F.exp(-z))
        loss = F.greatest(z, F.lit(0.0)) - z * F.col("toxic") + F.log1p(F.exp(-F.abs(z)))
        gradient = [F.sum((p - F.col("toxic")) * x) for x in columns]
        curve = [F.sum(p * (1 - p) * columns[i] * columns[j]) for i in range(size) for j in range(i + 1)]
        found = [v or 0.0 for v in rows.agg(F.sum(loss), *gradient, *curve).first()]
        matrix = np.zeros((size, size))
        matrix[np.tril_indices(size)] = found[1 + size :]
        matrix = matrix + np.tril(matrix, -1).T + RIDGE * np.eye(size)
        away = weights - prior
        return found[0] + RIDGE / 2 * away @ away, np.array(found[1 : 1 + size]) + RIDGE * away, matrix

    weights, (loss, gradient, matrix) = prior, sums(prior)
    for _ in range(rounds):
        step = np.linalg.solve(matrix, gradient)
        if gradient @ step <= tolerance:
            return [float(w) for w in weights]
        while (tried := sums(weights - step))[0] > loss and gradient @ step > tolerance:
            step = step / 2
        weights, (loss, gradient, matrix) = weights - step, tried
    raise RuntimeError(f"weights still moved after {rounds} rounds")


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and hits of each row of ``docs`` (doc_id, text), learned from ``labels`` (doc_id, toxic).

    Only labels of rows whose crc32(doc_id as text) mod 5 is not 0 are learned from, at
    most FIT_ROWS of them, chosen by a hash of the id; null labels and ids, values other than 0
    and 1 and ids with both are left out. Scores depend on the text alone: equal texts
    have equal scores. Null and empty texts have no hit. Rows that repeat an id are rows
    of their own; as training rows all of them bear its label. Without any label, SEEDS
    and PRIOR decide. A null doc_id counts as empty text, whose crc32 is 0: held out.

    1. Of labelled copies one speaks; two thirds of the speakers give the lexicon
       (``learn``), the others, which it has not seen, the weights of the features.
    2. Every word of every text runs through the Levenshtein automaton of the lexicon.
       A hit's window tells abuse (more hits, somebody addressed) from quotation
       (quotation marks, a reporting word before it).
    3. A logistic regression on the features gives the score.

    The lexicon, known words and weights go to every task; they are bounded by FIT_ROWS
    and TERMS. All else covers all rows, one pass over whole texts, without a shuffle.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("body"))
    speakers = _speakers(docs, _labelled(labels))
    rows = written(_measured(docs, learn(docs, speakers)), "measured")
    weighing = speakers.where("weighing").select(F.col("doc_id").alias("id"), "toxic")
    weights = fitted(written(rows.join(F.broadcast(weighing), F.col("doc_id") == F.col("id")).select("toxic", *FEATURES), "weighing"))
    score = 1 / (1 + F.exp(-_logit(weights)))
    return rows.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), score.alias("score"), (score >= 0.5).cast("int").alias("predicted"), "n_hits", "n_misspelled", "n_quoted"
    )
