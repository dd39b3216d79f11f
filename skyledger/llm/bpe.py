"""Byte-pair encoding of words by guess and check, and decoding."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyledger.llm.words import in_chunks

END = "</w>"
#: Texts are cut at blanks into pieces of about this many characters: no word spans a blank.
PIECE = 1 << 20
#: Words of a generation that a worker remembers, and the longest of them.
REMEMBERED, REMEMBERED_LENGTH = 100_000, 40
#: Longer words are merged one by one with a heap.
SHORT = 200
NEVER = np.int64(1) << 40


def _byte_letters() -> str:
    """The printable letter that stands for each byte: itself where printable, else from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, spare = [""] * 256, 256
    for byte in range(256):
        if byte in plain:
            letters[byte] = chr(byte)
        else:
            letters[byte], spare = chr(spare), spare + 1
    return "".join(letters)


LETTERS = _byte_letters()


class WordBpe:
    """Encoder and decoder for a tokenizer file with word ends, as tokenizers writes it."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        kinds = [step["type"] for step in spec["normalizer"]["normalizers"]]
        if kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] is not None or spec["model"]["end_of_word_suffix"] != END:
            raise ValueError("not a tokenizer of the kind this encoder knows")
        self.vocab: dict[str, int] = spec["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.size = max(self.vocab.values()) + 1
        #: rank of the merge that makes a token (-1: a byte), and its two parts
        self.made = np.full(self.size, -1, dtype=np.int64)
        self.left, self.right = np.arange(self.size), np.arange(self.size)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, token = self.vocab[a], self.vocab[b], self.vocab[a + b]
            self.ranks[left, right] = (rank, token)
            self.made[token], self.left[token], self.right[token] = rank, left, right
        pairs = np.array([a * self.size + b for a, b in self.ranks], dtype=np.int64)
        order = np.argsort(pairs)
        self.pairs, self.pair_ranks = pairs[order], np.array([r for r, _ in self.ranks.values()], dtype=np.int64)[order]
        self.pair_tokens = np.array([t for _, t in self.ranks.values()], dtype=np.int64)[order]
        self.longest = max(map(len, self.vocab))

        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special = regex.compile("(" + "|".join(map(regex.escape, self.specials)) + ")")
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern.replace(r"\s", r"\p{White_Space}"))
        self.names = np.empty(max([self.size, *(i + 1 for i in self.specials.values())]), dtype=object)
        for token, i in [*self.vocab.items(), *self.specials.items()]:
            self.names[i] = token
        self.known: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _letters(self, word: str) -> str:
        return word if word.isascii() and word.isprintable() else "".join(LETTERS[b] for b in word.encode())

    def guess(self, word: str) -> list[int]:
        """Greedy tokens of a word in byte letters: always the longest that fits."""
        vocab, at, out, n = self.vocab, 0, [], len(word)
        while at < n:
            if n - at <= self.longest and (token := vocab.get(word[at:] + END)) is not None:
                out.append(token)
                break
            for end in range(min(n - 1, at + self.longest), at, -1):
                if (token := vocab.get(word[at:end])) is not None:
                    out.append(token)
                    at = end
                    break
        return out

    def compatible(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether exact merging of two tokens' bytes ends in just these two, for many pairs at once.

        It does unless, at some moment, the two pieces that touch across the border form
        a merge of lower rank than the merges that consume them. The moments are visited
        backwards: of the two pieces, the one made later is taken apart. Of merges with
        equal rank the one further left comes first.
        """
        left, right = left.copy(), right.copy()
        until_left = np.full(len(left), NEVER)
        until_right = np.full(len(left), NEVER)
        good = np.ones(len(left), dtype=bool)
        live = np.arange(len(left))
        while len(live):
            a, b = left[live], right[live]
            key = a * self.size + b
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.where(self.pairs[at] == key, self.pair_ranks[at], NEVER)
            good[live] = ~((rank < until_left[live]) & (rank <= until_right[live]) & (rank < NEVER))
            made_a, made_b = self.made[a], self.made[b]
            undo_a = made_a > made_b
            until_left[live] = np.where(undo_a, made_a, until_left[live])
            until_right[live] = np.where(undo_a, until_right[live], made_b)
            left[live] = np.where(undo_a, self.right[a], a)
            right[live] = np.where(undo_a, b, self.left[b])
            live = live[good[live] & (np.maximum(made_a, made_b) >= 0)]
        return good

    def merge(self, word: str) -> list[int]:
        """Exact merging: lowest rank first, then leftmost; n log n in the word's length."""
        ids = [self.vocab[c] for c in word[:-1]] + [self.vocab[word[-1] + END]]
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(*self.ranks[p], i, p) for i, p in enumerate(zip(ids, ids[1:])) if p in self.ranks]
        heapq.heapify(heap)
        while heap:
            _, token, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] != pair[0] or j >= n or ids[j] != pair[1]:
                continue
            ids[i], ids[j] = token, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                if (p := (token, ids[after[j]])) in self.ranks:
                    heapq.heappush(heap, (*self.ranks[p], i, p))
            if before[i] >= 0 and (p := (ids[before[i]], token)) in self.ranks:
                heapq.heappush(heap, (*self.ranks[p], before[i], p))
        return [i for i in ids if i >= 0]

    def merge_short(self, words: Sequence[str]) -> list[list[int]]:
        """Exact merging of many words side by side: each round merges every word's lowest rank."""
        tokens = np.fromiter((t for w in words for t in (*map(self.vocab.__getitem__, w[:-1]), self.vocab[w[-1] + END])), dtype=np.int64)
        word = np.repeat(np.arange(len(words)), [len(w) for w in words])
        done: list[list[int]] = [[] for _ in words]
        while len(tokens):
            key = np.full(len(tokens), -1, dtype=np.int64)
            same = word[1:] == word[:-1]
            key[:-1][same] = tokens[:-1][same] * self.size + tokens[1:][same]
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            rank = np.where(self.pairs[at] == key, self.pair_ranks[at], NEVER)
            starts = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            lowest = np.repeat(np.minimum.reduceat(rank, starts), np.diff(np.r_[starts, len(word)]))
            ready = lowest == NEVER
            if ready.any():
                ends = np.flatnonzero(np.r_[True, word[ready][1:] != word[ready][:-1]])
                for i, ids in zip(word[ready][ends], np.split(tokens[ready], ends[1:])):
                    done[i] = ids.tolist()
            hit = (rank == lowest) & ~ready
            place = np.arange(len(tokens))
            run = np.maximum.accumulate(np.where(hit & ~np.r_[False, hit[:-1]], place, 0))
            first = hit & ((place - run) % 2 == 0)  # in a run of equal pairs, every other one from the left
            tokens[first] = self.pair_tokens[at[first]]
            keep = ~ready & ~np.r_[False, first[:-1]]
            tokens, word = tokens[keep], word[keep]
        return done

    def encode_words(self, words: Sequence[str]) -> list[list[int]]:
        """Guess all words, check all their neighbouring tokens at once, merge only those that fail."""
        letters = [self._letters(w) for w in words]
        guesses = [self.guess(w) for w in letters]
        flat = np.fromiter((t for g in guesses for t in g), dtype=np.int64)
        word = np.repeat(np.arange(len(guesses)), [len(g) for g in guesses])
        inner = np.flatnonzero(word[1:] == word[:-1])
        failing = np.unique(word[inner[~self.compatible(flat[inner], flat[inner + 1])]]).tolist()
        short = [i for i in failing if len(letters[i]) <= SHORT]
        for i, ids in zip(short, self.merge_short([letters[i] for i in short])):
            guesses[i] = ids
        for i in failing:
            if len(letters[i]) > SHORT:
                guesses[i] = self.merge(letters[i])
        return guesses

    def _pieces(self, text: str) -> Iterator[str]:
        start = 0
        while start < len(text):
            end = start + PIECE
            if end < len(text):
                while end < len(text) and text[end] not in " \n\t":
                    end += 1
            yield text[start:end]
            start = end

    def _normal(self, text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")  # a lone letter knows no word end
        return text.lower()

    def _remember(self, words: set[str]) -> dict[str, bytes]:
        """The encoded words. Frequent ones stay known: those of the last generation are looked up too."""
        out = {}
        for w in words:
            if (ids := self.known.get(w)) is None and (ids := self.old.get(w)) is not None:
                self.known[w] = ids
            out[w] = ids
        new = [w for w, ids in out.items() if ids is None]
        for w, ids in zip(new, self.encode_words(new) if new else []):
            out[w] = np.array(ids, dtype="<u4").tobytes()
            if len(w) <= REMEMBERED_LENGTH:
                self.known[w] = out[w]
        if len(self.known) > REMEMBERED:
            self.known, self.old = {}, self.known
        return out

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers; special tokens' strings are those tokens.

        Words are looked up for about PIECE characters at a time, over the borders of texts.
        """
        parts: list[tuple[int, list[str] | bytes]] = []
        held, done, i = 0, {}, -1
        first = 0

        def flush() -> None:
            ids = self._remember(set().union(*(p for _, p in parts if isinstance(p, list))))
            for k, p in parts:
                done.setdefault(k, []).append(p if isinstance(p, bytes) else b"".join(map(ids.__getitem__, p)))
            parts.clear()

        for i, text in enumerate(texts):
            for piece in self._pieces(text):
                for part in self.special.split(piece) if "<|" in piece else [piece]:
                    if part in self.specials:
                        parts.append((i, np.array([self.specials[part]], dtype="<u4").tobytes()))
                    else:
                        parts.append((i, self.words.findall(self._normal(part))))
                held += len(piece)
                if held >= PIECE:
                    flush()
                    held = 0
            if not parts:
                for k in range(first, i + 1):
                    yield b"".join(done.pop(k, []))
                first = i + 1
        flush()
        for k in range(first, i + 1):
            yield b"".join(done.pop(k, []))

    def encode(self, text: str) -> bytes:
        return next(self.encode_all([text]))

    def decode(self, ids: bytes) -> str:
        """Tokens with a blank between them, special tokens included: the file names no decoder."""
        return " ".join(self.names[np.frombuffer(ids, dtype="<u4")].tolist())


@functools.cache
def _bpe(path: str) -> WordBpe:
    return WordBpe(path if os.path.exists(path) else SparkFiles.get(os.path.basename(path)))


def encoded(docs: DataFrame, path: str, text: str = "text", with_ids: bool = False, carry: Sequence[str] = ("*",)) -> DataFrame:
    """Columns ``carry`` of ``docs`` as struct ``row`` with n_tokens, ids_sha256 and decoded_sha256; ``with_ids`` adds ids as an array.

    ``path`` is the tokenizer file on the driver; Spark carries it to executors that do
    not have it. Null texts encode as empty. Each task reads its rows in batches and a
    text in pieces; nothing is shuffled.
    """
    docs.sparkSession.sparkContext.addFile(path)
    kind = "struct<n_tokens: long, ids_sha256: string, decoded_sha256: string" + (", ids: array<int>>" if with_ids else ">")

    @F.pandas_udf(kind)
    def encode(parts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bpe = _bpe(path)
        for texts in parts:
            rows = []
            for ids in bpe.encode_all(value or "" for value in texts):
                row = (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                rows.append((*row, np.frombuffer(ids, dtype="<i4")) if with_ids else row)
            yield pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"] + ["ids"] * with_ids)

    return docs.select(F.struct(*carry).alias("row"), F.col(text).alias("body")).select("row", encode("body").alias("code")).select("row", "code.*")


def tokenized(docs: DataFrame, path: str, text: str = "text", carry: Sequence[str] = ("*",)) -> DataFrame:
    """``encoded`` with the token ids themselves, as ``ids``.

    Ids leave a task in frames of about a million characters of text, whatever the size of
    the batches that come in, so that neither side holds the ids of a whole batch.
    """
    docs.sparkSession.sparkContext.addFile(path)
    rows = docs.select(F.struct(*carry).alias("row"), F.col(text).alias("body"))
    kind = ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in rows.schema["row"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _bpe(path)
        for batch in batches:
            at = 0
            for chunk in in_chunks(value.as_py() for value in batch.column("body")):
                codes = list(bpe.encode_all(chunk))
                sizes = np.array([len(ids) // 4 for ids in codes], dtype=np.int64)
                digests = [hashlib.sha256(ids).hexdigest() for ids in codes]
                decoded = [hashlib.sha256(bpe.decode(ids).encode()).hexdigest() for ids in codes]
                ends = pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32))
                ids = pa.ListArray.from_arrays(ends, pa.array(np.frombuffer(b"".join(codes), dtype="<i4")))
                head = batch.column("row").slice(at, len(chunk))
                yield pa.record_batch([head, pa.array(sizes), ids, pa.array(digests), pa.array(decoded)], ["row", "n_tokens", "ids", "ids_sha256", "decoded_sha256"])
                at += len(chunk)

    return rows.mapInArrow(run, f"row struct<{kind}>, n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string")
