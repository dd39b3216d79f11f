"""URL rules in a sorted array of 64-bit digests, memory-mapped and probed in batches."""

from __future__ import annotations

import functools
import os
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class UrlRule:
    """``verdict`` for a host with all its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or without ``://``."""
    after = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(after, r"^[^/?#]*", 0), UPPER, LOWER)
    return host, F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)


def write_index(rules: Sequence[UrlRule], path: str, hash_of=xxhash.xxh64_intdigest) -> None:
    """One file: count, digests in order, where each rule's text ends and its host ends, verdicts, texts.

    The rules are configuration and fit the driver; executors map the file, so that only
    the pages a search touches are read and workers of one machine share them.
    """
    verdicts = sorted({rule.verdict for rule in rules})
    entries = sorted((hash_of(rule.text.encode()), rule.text, len(rule.host.encode()), verdicts.index(rule.verdict)) for rule in dict.fromkeys(rules))
    if len({(text, host) for _, text, host, _ in entries}) < len(entries):
        raise ValueError("two rules for one host and path disagree")
    texts = [text.encode() for _, text, _, _ in entries]
    names = "\n".join(verdicts).encode()
    with open(path, "wb") as out:
        out.write(np.array([len(entries), len(names)], dtype="<u8").tobytes())
        out.write(np.array([e[0] for e in entries], dtype="<u8").tobytes())
        out.write(np.cumsum([0] + [len(t) for t in texts]).astype("<u8").tobytes())
        out.write(np.array([e[2] for e in entries], dtype="<u8").tobytes())
        out.write(np.array([e[3] for e in entries], dtype="<u8").tobytes())
        out.write(names + b"".join(texts))


class Index:
    """A mapped index file: ``find`` answers many keys at once."""

    def __init__(self, path: str, hash_of=xxhash.xxh64_intdigest) -> None:
        n, length = (int(x) for x in np.fromfile(path, dtype="<u8", count=2))
        places = np.cumsum([2, n, n + 1, n, n])
        data = np.memmap(path, dtype="u1", mode="r")
        self.hash_of, self.n = hash_of, n
        parts = [data[8 * a : 8 * b].view("<u8") for a, b in zip(places, places[1:])]
        self.keys, self.ends, self.hosts, self.kinds = parts
        start = 8 * int(places[-1])
        self.verdicts = bytes(data[start : start + length]).decode().split("\n")
        self.texts = data[start + length :]
        labels, lengths = set(), set()
        for i in range(n):
            text, host = self.text(i), int(self.hosts[i])
            labels.add(text[:host].count(b".") + 1)
            lengths.add(len(text[host:].decode()))
        self.labels, self.lengths = sorted(labels), sorted(lengths)

    def text(self, i: int) -> bytes:
        return bytes(self.texts[int(self.ends[i]) : int(self.ends[i + 1])])

    def find(self, hosts: Sequence[bytes], paths: Sequence[bytes]) -> np.ndarray:
        """The entry whose host and path are these, or -1: a binary search over all keys, then the stored texts."""
        wanted = [h + p for h, p in zip(hosts, paths)]
        digests = np.fromiter(map(self.hash_of, wanted), dtype=np.uint64, count=len(wanted))
        found = np.full(len(wanted), -1, dtype=np.int64)
        first = np.searchsorted(self.keys, digests, side="left")
        last = np.searchsorted(self.keys, digests, side="right")
        for i in np.flatnonzero(last > first):
            for entry in range(int(first[i]), int(last[i])):  # more than one only where digests collide
                if int(self.hosts[entry]) == len(hosts[i]) and self.text(entry) == wanted[i]:
                    found[i] = entry
        return found

    def best(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """The entry of the longest rule that fits each url, or -1; of equal lengths the longer host.

        A rule's host is one of the url's last labels and its path a prefix, so only the
        label counts and path lengths that occur in the index are tried.
        """
        best = np.full(len(hosts), -1, dtype=np.int64)
        score = np.zeros(len(hosts), dtype=np.int64)
        for labels in self.labels:
            split = [host.rsplit(".", labels) for host in hosts]
            at = [i for i, parts in enumerate(split) if len(parts) >= labels]
            tails = {i: ".".join(split[i][-labels:]) for i in at}
            for length in self.lengths:
                some = [i for i in at if len(paths[i]) >= length]
                entries = self.find([tails[i].encode("utf-8", "surrogatepass") for i in some], [paths[i][:length].encode("utf-8", "surrogatepass") for i in some])
                rank = np.array([(len(tails[i]) + length) * 1_000_000 + min(len(tails[i]), 999_999) for i in some], dtype=np.int64)
                some = np.array(some, dtype=np.int64)
                better = (entries >= 0) & (rank > score[some])
                best[some[better]], score[some[better]] = entries[better], rank[better]
        return best


@functools.cache
def _index(name: str) -> Index:
    return Index(SparkFiles.get(name))


def publish(spark: SparkSession, rules: Sequence[UrlRule]) -> str:
    """Build the index on the driver and let Spark carry the file to every executor; its name there."""
    name = f"url-rules-{uuid.uuid4().hex}.bin"
    path = os.path.join(tempfile.mkdtemp(prefix="urls-"), name)
    write_index(rules, path)
    spark.sparkContext.addFile(path)
    return name


def filtered(pages: DataFrame, rules: Sequence[UrlRule], url: str = "url", otherwise: str = "allow") -> DataFrame:
    """``pages`` as struct ``row`` with host, path, rule and verdict of each url.

    The longest rule that fits decides; a url that no rule fits gets ``otherwise``: a list
    says nothing about what it does not hold. Null urls have empty host and path, which no
    rule fits, and so have urls without ``://``. No shuffle; columns travel in ``row``.
    """
    name = publish(pages.sparkSession, rules)
    found_type = "struct<rule: string, verdict: string>"

    @F.pandas_udf(found_type)
    def look_up(host: pd.Series, path: pd.Series) -> pd.DataFrame:
        index = _index(name)
        entries = index.best(host.tolist(), path.tolist())
        return pd.DataFrame(
            {
                "rule": [index.text(e).decode() if e >= 0 else None for e in entries],
                "verdict": [index.verdicts[int(index.kinds[e])] if e >= 0 else otherwise for e in entries],
            }
        )

    host, path = host_and_path(F.col(url))
    rows = pages.select(F.struct("*").alias("row"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("found", look_up("host", "path"))
    return rows.select("row", "host", "path", "found.rule", "found.verdict")
