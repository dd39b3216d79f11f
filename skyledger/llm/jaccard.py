"""Documents whose word n-gram sets have a high Jaccard similarity, found without loss."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm.common import written
from skyledger.llm.components import components, spanning
from skyledger.llm.words import in_chunks, mix, shingle_sets

#: Shingles of the sets in one side of a tile pair, so that a task's memory is bounded; a larger set is a side of its own.
SIDE = 4_000_000


class Jaccard:
    """Sets are linked when 100 * intersection >= percent * union."""

    def __init__(self, percent: int = 85, width: int = 4) -> None:
        if not 50 < percent < 100:
            raise ValueError("percent must lie between 50 and 100")
        self.percent, self.width = percent, width

    def largest_difference(self, a: int, b: int) -> int:
        """How many shingles two linked sets of these sizes can have in only one of them."""
        return (100 - self.percent) * (a + b) // (100 + self.percent)

    def largest_partner(self, a: int) -> int:
        return 100 * a // self.percent

    def classes(self, n: int) -> list[tuple[int, int, int]]:
        """(class, buckets, spare buckets) under which a set of n shingles looks for partners.

        Sizes fall into bands that double. Class 2k holds band k; class 2k + 1 the upper
        end of band k - 1 and the lower end of band k, as far as partners reach across
        the border. The number of buckets depends on the class alone.
        """
        k = n.bit_length()
        border, beyond = 1 << (k - 1), 1 << k  # this band's sizes are border..beyond-1
        out = [(2 * k, *self._buckets(beyond - 1, beyond - 1))]
        if n <= self.largest_partner(border - 1):
            out.append((2 * k + 1, *self._buckets(border - 1, self.largest_partner(border - 1))))
        if self.largest_partner(n) >= beyond:
            out.append((2 * k + 3, *self._buckets(beyond - 1, self.largest_partner(beyond - 1))))
        return out

    def _buckets(self, a: int, b: int) -> tuple[int, int]:
        least = self.largest_difference(a, b) + 1
        spare = 3 + least // 10
        return least + spare, spare

    def signatures(self, hashes: np.ndarray) -> np.ndarray:
        """Keys of the tiles of a set: linked sets share one at least.

        The hash range is cut into more buckets than two linked sets can differ in, so
        some buckets hold the same shingles in both; a key stands for a class, a bucket
        and all it holds. Empty buckets have no key. More buckets than needed make up
        for them; a set in which more are empty than that also takes the keys of its
        prefix, the smallest hashes, one of which any two linked sets share.
        """
        n, out = len(hashes), []
        for name, buckets, spare in self.classes(n):
            bucket = ((hashes >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
            first = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            held = np.add.reduceat(mix(hashes), first)
            out.append(mix(held ^ mix(bucket[first] * np.uint64(512) + np.uint64(2 * name))))
            if buckets - len(first) > spare:
                prefix = n - (self.percent * n + 99) // 100 + 1
                out.append(mix(hashes[:prefix] ^ mix(np.uint64([2 * name + 1]))))
        return np.concatenate(out)

    @staticmethod
    def bitmap(hashes: np.ndarray) -> np.ndarray:
        """A bitmap with one bit per hash and 8 to 16 places a shingle; halves fold onto each other."""
        bits = max(64, 8 << len(hashes).bit_length())
        at = np.unique(mix(hashes ^ np.uint64(0x5BF0)) & np.uint64(bits - 1))
        word = (at >> np.uint64(6)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
        out = np.zeros(bits // 64, dtype=np.uint64)
        out[word[first]] = np.bitwise_or.reduceat(np.uint64(1) << (at & np.uint64(63)), first)
        return out

    @staticmethod
    def folded(bitmap: np.ndarray, words: int) -> np.ndarray:
        while len(bitmap) > words:
            bitmap = bitmap[: len(bitmap) // 2] | bitmap[len(bitmap) // 2 :]
        return bitmap

    @staticmethod
    def sketch(hashes: np.ndarray) -> np.ndarray:
        """How many shingles fall on each of n/8 to n/4 counters (16 at least), 255 at most; halves fold onto each other."""
        counters = max(16, (1 << len(hashes).bit_length()) >> 3)
        at = (mix(hashes ^ np.uint64(0x2E6B)) & np.uint64(counters - 1)).astype(np.int64)
        return np.minimum(np.bincount(at, minlength=counters), 255).astype(np.uint8)

    @staticmethod
    def halved(sketch: np.ndarray, counters: int) -> np.ndarray:
        """The sketch as on fewer counters, in numbers that hold sums."""
        return sketch.reshape(-1, counters).sum(0, dtype=np.int32)

    def may_link(self, a: int, x: np.ndarray, b: int, y: np.ndarray) -> bool:
        """Counters of two sets differ in sum by no more than the sets do; if that is too much, no link."""
        if 100 * min(a, b) < self.percent * max(a, b):
            return False
        counters = min(len(x), len(y))
        return int(np.abs(self.halved(x, counters) - self.halved(y, counters)).sum()) <= self.largest_difference(a, b)

    def enough(self, common: int, a: int, b: int) -> bool:
        return 100 * common >= self.percent * (a + b - common)


def set_id(hashes: np.ndarray) -> int:
    """A 64-bit name for a set, as a signed number; sets with one name count as equal."""
    if not len(hashes):
        return 0
    total = np.add.reduce(mix(hashes ^ np.uint64(0xA0761D6478BD642F))) ^ np.uint64(len(hashes))
    return int(mix(np.array([total], dtype=np.uint64)).view(np.int64)[0]) | 1


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """Size of the intersection of two sorted arrays."""
    if len(x) > len(y):
        x, y = y, x
    return int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())


def _sets(docs: DataFrame, rule: Jaccard) -> DataFrame:
    """id, n, set and sketch of each document; the empty set is named 0. Of copies in a task, one has the sketch."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            found: list[tuple[int, int, bytes | None]] = []
            for chunk in in_chunks(batch["text"]):
                for hashes in shingle_sets(chunk, rule.width):
                    name = set_id(hashes)
                    told = len(hashes) < 2 or name in seen
                    found.append((len(hashes), name, None if told else rule.sketch(hashes).tobytes()))
                    seen.add(name)
            yield batch[["id"]].assign(n=[n for n, _, _ in found], set=[s for _, s, _ in found], sketch=[k for _, _, k in found])

    return docs.mapInPandas(run, "id long, n long, set long, sketch binary")


def _signatures(docs: DataFrame, rule: Jaccard) -> DataFrame:
    """key, set and n, once per task for each set: of copies, one speaks."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: set[int] = set()
        for batch in batches:
            for chunk in in_chunks(batch["text"]):
                keys, names, sizes = [], [], []
                for hashes in shingle_sets(chunk, rule.width):
                    name = set_id(hashes)
                    if len(hashes) > 1 and name not in seen:
                        seen.add(name)
                        keys.append(rule.signatures(hashes))
                        names.append(name)
                        sizes.append(len(hashes))
                if keys:
                    times = [len(k) for k in keys]
                    yield pd.DataFrame({"key": np.concatenate(keys).view(np.int64), "set": np.repeat(names, times), "n": np.repeat(sizes, times)})

    return docs.select("text").mapInPandas(run, "key long, set long, n int")


def spanning_links(names: list[int], sides: list[int], hashes: list[np.ndarray], rule: Jaccard) -> list[tuple[int, int]]:
    """Links that connect whatever links connect among these sets; with two sides, only across them.

    Sets ascend by size, and each looks at the larger ones within reach that it is not
    yet connected with. A bit set in only one bitmap stands for a shingle at least that
    only its set has: that bounds the intersection from above, for many sets at once.
    Where the bound allows a link, the sorted arrays are intersected.
    """
    order = sorted(range(len(names)), key=lambda k: len(hashes[k]))
    names, sides = [names[k] for k in order], np.array([sides[k] for k in order])
    hashes = [hashes[k] for k in order]
    bitmaps = [rule.bitmap(h) for h in hashes]
    sizes, widths = np.array([len(h) for h in hashes]), np.array([len(b) for b in bitmaps])
    two, links, root = len(set(sides.tolist())) > 1, [], np.arange(len(names))
    for width in np.unique(widths):
        wide = np.flatnonzero(widths >= width)
        rows = np.stack([rule.folded(bitmaps[k], int(width)) for k in wide])
        for i in np.flatnonzero(widths == width):
            reach = np.searchsorted(sizes, rule.largest_partner(int(sizes[i])), side="right")
            some = wide[(wide > i) & (wide < reach)]
            some = some[root[some] != root[i]]
            if two:
                some = some[sides[some] != sides[i]]
            if not len(some):
                continue
            mine, theirs = rows[i - wide[0]], rows[some - wide[0]]
            common = np.minimum(sizes[i] - np.bitwise_count(mine & ~theirs).sum(1, dtype=np.int64), sizes[some] - np.bitwise_count(theirs & ~mine).sum(1, dtype=np.int64))
            for j in some[rule.enough(common, sizes[i], sizes[some])]:
                if root[j] != root[i] and rule.enough(_common(hashes[i], hashes[j]), int(sizes[i]), int(sizes[j])):
                    root[root == root[j]] = root[i]
                    links.append((names[i], names[j]))
    return links


def _runs(signatures: DataFrame, rule: Jaccard) -> DataFrame:
    """run, lead, set, wide: the sets of each key, cut where neighbouring sizes are out of reach of each other.

    Runs of the same sets are one, whatever their keys. The lead is a run's smallest set; a run of two sets is not wide.
    """
    by_size = Window.partitionBy("key").orderBy("n", "set")
    # several tasks speak for copies that are in each of them
    rows = signatures.repartition("key").withColumn("again", F.lag("set").over(by_size)).where("again IS NULL OR again <> set")
    rows = rows.withColumn("sets", F.count("*").over(Window.partitionBy("key"))).where("sets > 1")
    out_of_reach = F.col("n") * rule.percent > F.lag("n").over(by_size) * 100
    rows = rows.withColumn("gap", F.coalesce(out_of_reach.cast("int"), F.lit(0))).withColumn("run", F.sum("gap").over(by_size))
    in_run = Window.partitionBy("key", "run")
    rows = rows.select(
        "set",
        F.first("set").over(in_run.orderBy("n", "set")).alias("lead"),
        F.count("*").over(in_run).alias("sets"),
        F.bit_xor(F.xxhash64("set")).over(in_run).alias("all"),
    ).where("sets > 1")
    return rows.select(F.xxhash64("lead", "sets", "all").alias("run"), "lead", "set", (F.col("sets") > 2).alias("wide")).distinct()


def _lead_links(runs: DataFrame, sketches: DataFrame, rule: Jaccard) -> DataFrame:
    """(a, b): leads and sets of their runs that may link, by their sketches."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            pairs = zip(batch["n"], batch["sketch"], batch["n_b"], batch["sketch_b"])
            kept = [rule.may_link(n, np.frombuffer(x, np.uint8), m, np.frombuffer(y, np.uint8)) for n, x, m, y in pairs]
            yield batch.loc[np.array(kept, dtype=bool), ["a", "b"]]

    pairs = runs.where("set <> lead").select(F.col("lead").alias("a"), F.col("set").alias("b")).distinct()
    of_b = sketches.select(F.col("set").alias("b"), F.col("n").alias("n_b"), F.col("sketch").alias("sketch_b"))
    pairs = pairs.join(sketches.withColumnRenamed("set", "a"), "a").join(of_b, "b")
    return pairs.mapInPandas(run, "a long, b long")


def class_links(classes: list[int], sizes: list[int], sketches: list[np.ndarray], rule: Jaccard) -> list[tuple[int, int]]:
    """Links that connect the classes of which some sets may link, by their sketches."""
    order = sorted(range(len(sizes)), key=lambda k: sizes[k])
    n, sketches = np.array([sizes[k] for k in order]), [sketches[k] for k in order]
    names, root = np.unique(np.array([classes[k] for k in order], dtype=np.int64), return_inverse=True)
    widths, links = np.array([len(x) for x in sketches]), []
    for width in np.unique(widths):
        wide = np.flatnonzero(widths >= width)
        rows = np.stack([rule.halved(sketches[k], int(width)) for k in wide])
        for i in np.flatnonzero(widths == width):
            reach = np.searchsorted(n, rule.largest_partner(int(n[i])), side="right")
            some = np.flatnonzero((wide > i) & (wide < reach))
            some = some[root[wide[some]] != root[i]]
            apart = np.abs(rows[some] - rows[i - wide[0]]).sum(1)
            for j in wide[some[apart <= (100 - rule.percent) * (n[i] + n[wide[some]]) // (100 + rule.percent)]]:
                if root[j] != root[i]:
                    links.append((int(names[root[i]]), int(names[root[j]])))
                    root[root == root[j]] = root[i]
    return links


def _class_links(runs: DataFrame, classes: DataFrame, sketches: DataFrame, rule: Jaccard) -> DataFrame:
    """(a, b): classes that meet in a run in which any of their sets may link; a task holds one run at a time."""

    def links(part: pd.DataFrame) -> list[tuple[int, int]]:
        return class_links(part["class"].tolist(), part["n"].tolist(), [np.frombuffer(x, np.uint8) for x in part["sketch"]], rule)

    members = runs.where("wide").select("run", "set").join(classes, "set")
    mixed = members.groupBy("run").agg(F.min("class").alias("least"), F.max("class").alias("most")).where("least <> most").select("run")
    rows = members.join(mixed, "run").join(sketches, "set").select("run", "class", "n", "sketch")
    return _by_group(rows, "run", links)


def _by_group(rows: DataFrame, group: str, links: Callable[[pd.DataFrame], list[tuple[int, int]]]) -> DataFrame:
    """(a, b) of each group of rows; they come by group, and a task holds one at a time."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def ended() -> list[tuple[int, int]]:
            return links(held[0] if len(held) == 1 else pd.concat(held))

        for batch in batches:
            out: list[tuple[int, int]] = []
            names = batch[group].to_numpy()
            start = 0
            for end in (np.flatnonzero(np.r_[names[1:] != names[:-1], True]) + 1).tolist():
                part = batch.iloc[start:end]
                if held and held[0][group].iloc[0] != part[group].iloc[0]:
                    out += ended()
                    held.clear()
                held.append(part)
                start = end
            yield pd.DataFrame(out, columns=["a", "b"])
        if held:
            yield pd.DataFrame(ended(), columns=["a", "b"])

    return rows.repartition(group).sortWithinPartitions(group).mapInPandas(run, "a long, b long")


def _tile_links(rows: DataFrame, rule: Jaccard) -> DataFrame:
    """Spanning links of each tile of (tile, side, set, text)."""

    def links(part: pd.DataFrame) -> list[tuple[int, int]]:
        hashes = (h for chunk in in_chunks(part["text"]) for h in shingle_sets(chunk, rule.width))
        # an id that several texts bear brings all of them: each set is taken once, under its own name
        kept = {(name, side): h for name, side, h in zip(part["set"], part["side"], hashes) if set_id(h) == name}
        return spanning_links([n for n, _ in kept], [side for _, side in kept], list(kept.values()), rule)

    return _by_group(rows, "tile", links)


def jaccard_components(docs: DataFrame, rule: Jaccard | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text).

    component_id is the smallest doc_id that links reach, the row's own included. Null
    and empty texts and texts of blanks have no shingles and link with nothing. Rows
    with equal sets are linked, however many there are; rows that repeat a doc_id are
    rows of their own. A component whose ids are all null has a null component_id.

    1. Each distinct set sends its name under its keys (``Jaccard.signatures``): sets
       that link share a key. A key's sets are cut where neighbouring sizes are out of
       reach of each other; what remains of several sets is a run.
    2. Sets that share a phrase may share a key too, the more of them the larger the table:
       runs alone would connect most of it. So sets count as connected only if their sketches
       allow a link (``Jaccard.may_link``): first each run's smallest set and the others; then, in
       runs of sets that this leaves in several classes, all sets of different classes.
    3. Sets so connected form a block; no link leaves it. A block that one task can
       hold is one tile; others are cut by size band, and bands into sides of bounded
       bytes, and sides are paired where their sizes allow a link. A set travels once
       per tile that it is in.
    4. A tile pair finds spanning links by bitmaps and exact intersection, so that a
       large group of near copies gives as many rows as it has members, not its square.
    """
    rule = rule or Jaccard()
    docs = docs.select(F.col("doc_id").cast("long").alias("id"), "text")
    lean = written(_sets(docs, rule), "sets")
    sketches = written(lean.where("sketch IS NOT NULL").select("set", "n", "sketch").dropDuplicates(["set"]), "sketches")
    lean = lean.drop("sketch")
    runs = written(_runs(_signatures(docs, rule), rule), "runs")
    near = components(spanning(_lead_links(runs, sketches, rule)))
    near = near.select(F.col("node").alias("set"), F.col("component").alias("near"))
    classes = runs.select("set").distinct().join(near, "set", "left").select("set", F.coalesce("near", "set").alias("class"))
    classes = written(classes, "classes")
    joined = components(_class_links(runs, classes, sketches, rule))
    joined = joined.select(F.col("node").alias("class"), F.col("component").alias("joined"))
    blocks = classes.join(joined, "class", "left").select("set", F.coalesce("joined", "class").alias("block"))

    speakers = lean.groupBy("set").agg(F.min("id").alias("id"), F.max("n").alias("n")).join(blocks, "set")
    totals = speakers.groupBy("block").agg((F.sum("n") > SIDE).alias("large"), F.count("*").alias("sets")).where("sets > 1").drop("sets")
    speakers = written(speakers.join(totals, "block"), "blocks")
    before = Window.partitionBy("block", "band").orderBy("n", "set").rowsBetween(Window.unboundedPreceding, -1)
    large = speakers.where("large").withColumn("band", F.expr("length(bin(n))"))
    large = large.withColumn("part", F.floor(F.coalesce(F.sum("n").over(before), F.lit(0)) / SIDE))
    small = speakers.where("NOT large").withColumn("band", F.lit(0)).withColumn("part", F.lit(0).cast("long"))
    speakers = large.unionByName(small)
    speakers = written(speakers, "speakers")
    x = speakers.groupBy("block", "band", "part").agg(F.min("n").alias("least"), F.max("n").alias("most"), F.count("*").alias("sets"))
    y = x.select("block", *[F.col(c).alias(f"{c}_y") for c in ("band", "part", "least", "sets")])
    later = (F.col("band_y") > F.col("band")) | ((F.col("band_y") == F.col("band")) & (F.col("part_y") > F.col("part")))
    itself = (F.col("band_y") == F.col("band")) & (F.col("part_y") == F.col("part")) & (F.col("sets") > 1)
    in_reach = F.col("least_y") * rule.percent <= F.col("most") * 100
    pairs = x.join(y, "block").where(itself | (later & in_reach))
    pairs = pairs.withColumn("tile", F.xxhash64("block", "band", "part", "band_y", "part_y")).withColumn("alone", itself)
    pairs = written(pairs.select("block", "band", "part", "band_y", "part_y", "most", "least_y", "tile", "alone"), "tile-pairs")
    # of two sides, only the sets that reach into the other travel
    here = pairs.select("block", "band", "part", "tile", F.lit(0).alias("side"), F.when(~F.col("alone"), F.col("least_y")).alias("reach_down"), F.lit(None).cast("long").alias("reach_up"))
    there = pairs.where("NOT alone").select("block", F.col("band_y").alias("band"), F.col("part_y").alias("part"), "tile", F.lit(1).alias("side"), F.lit(None).cast("long").alias("reach_down"), F.col("most").alias("reach_up"))
    members = speakers.join(here.unionByName(there), ["block", "band", "part"])
    members = members.where((F.col("reach_down").isNull() | (F.col("n") * 100 >= F.col("reach_down") * rule.percent)) & (F.col("reach_up").isNull() | (F.col("n") * rule.percent <= F.col("reach_up") * 100)))
    members = members.select(F.col("id").alias("speaker"), "set", "tile", "side")
    rows = docs.join(members, F.col("id").eqNullSafe(F.col("speaker"))).select("tile", "side", "set", "text")
    return _result(lean, components(_tile_links(rows, rule)))


def _result(lean: DataFrame, labels: DataFrame) -> DataFrame:
    named = lean.groupBy("set").agg(F.min("id").alias("id")).join(labels.withColumnRenamed("node", "set"), "set", "left")
    named = named.select("set", F.coalesce("component", "set").alias("component"), "id")
    smallest = named.groupBy("component").agg(F.min("id").alias("component_id"))
    classes = named.join(smallest, "component").select("set", "component_id")
    # rows without shingles are alone, and would be one hot key
    full = lean.where("n > 0").join(classes, "set")
    alone = lean.where("n = 0").withColumn("component_id", F.col("id"))
    columns = [F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id"]
    return full.select(*columns).unionByName(alone.select(*columns))
