"""SimHash near-duplicates through a Gray-order hierarchical index.

Distinct fingerprints are dealt by pigeonhole: with at most two differing bits, two of four 16-bit
blocks agree, so linked fingerprints meet under one of six 32-bit keys. A key with more than HOT
fingerprints is dealt again on two of four bytes of its free half, after which a group cannot hold more
than 65,536 of them. Inside a group, fingerprints are sorted by Gray rank and cut into nodes of FAN
neighbours; a node keeps the bit pattern that all below it share, and a search descends pairs of nodes,
adding up the differences in the bits newly fixed on each level and dropping a pair of whole groups as
soon as the sum passes the radius. A group hands on a spanning forest of its links, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import cut, pieces_for, table, words

RADIUS, HOT, FAN, CHUNK = 2, 4096, 8, 1 << 20


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """XXH64 (seed 42) of all word shingles in order; fewer words are one shingle."""
    w = words(text)
    whole, digest = b" ".join(w), xxhash.xxh64_intdigest
    if len(w) <= shingle:
        return np.array([digest(whole, 42)], dtype=np.uint64)
    ends = [e - 1 for e in accumulate(len(x) + 1 for x in w)]
    starts = [0, *(e + 1 for e in ends[:-shingle])]
    return np.array([digest(whole[s:e], 42) for s, e in zip(starts, ends[shingle - 1 :], strict=True)], dtype=np.uint64)


def majority(hashes: np.ndarray) -> int:
    """The bits set in over half the hashes."""
    h = hashes.astype("<u8").view(np.uint8).reshape(-1, 8)
    ones = sum(np.unpackbits(h[i : i + 65536], axis=1, bitorder="little").sum(0, dtype=np.int64) for i in range(0, len(h), 65536))
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Majority bits of the hashes of all word shingles; zero without words."""
    return majority(shingle_hashes(text, shingle)) if words(text) else 0


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        fps = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], dtype=np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps)], names=["id", "fp"])


def gray_rank(fps: np.ndarray) -> np.ndarray:
    """Place of each word in the reflected Gray sequence."""
    r = fps.copy()
    for s in (1, 2, 4, 8, 16, 32):
        r ^= r >> np.uint64(s)
    return r


class GrayIndex:
    """Levels of nodes over fingerprints sorted by (group, Gray rank); all groups of a batch share the arrays."""

    def __init__(self, groups: np.ndarray, fps: np.ndarray):
        order = np.lexsort((gray_rank(fps), groups))
        self.fps = fps[order]
        group = groups[order]
        full = np.full(len(fps), np.uint64(0xFFFFFFFFFFFFFFFF))
        self.levels = [(full, self.fps, None, None)]  # shared-bit mask, pattern, first child, number of children
        while True:
            heads = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
            if len(heads) == len(group):
                break
            place = np.arange(len(group)) - np.repeat(heads, np.diff(np.r_[heads, len(group)]))
            first = np.flatnonzero(place % FAN == 0)
            mask, pattern = self.levels[-1][:2]
            low, high = np.bitwise_and.reduceat(pattern, first), np.bitwise_or.reduceat(pattern, first)
            mask = np.bitwise_and.reduceat(mask, first) & ~(low ^ high)
            self.levels.append((mask, pattern[first] & mask, first, np.diff(np.r_[first, len(group)])))
            group = group[first]

    def links(self, radius: int = RADIUS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of places within the radius, a bounded frontier at a time."""
        top = len(self.levels) - 1
        roots = np.arange(len(self.levels[top][0]))
        todo = [(top, roots[i : i + CHUNK], roots[i : i + CHUNK], np.zeros(len(roots[i : i + CHUNK]), np.int64)) for i in range(0, len(roots), CHUNK)]
        while todo:
            level, a, b, spent = todo.pop()
            if not level:
                far = a != b
                yield a[far], b[far]
                continue
            mask, _, first, size = self.levels[level]
            fan = size[a] * size[b]
            for s in _runs(fan, CHUNK):
                n = fan[s]
                at = np.repeat(np.arange(len(n)), n)
                k = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
                pa_, pb = a[s][at], b[s][at]
                ca, cb = first[pa_] + k // size[pb], first[pb] + k % size[pb]
                keep = ca <= cb
                pa_, pb, ca, cb, acc = pa_[keep], pb[keep], ca[keep], cb[keep], spent[s][at][keep]
                m, p = self.levels[level - 1][:2]
                new = m[ca] & m[cb] & ~(mask[pa_] & mask[pb])
                acc = acc + np.bitwise_count((p[ca] ^ p[cb]) & new)
                near = acc <= radius
                if near.any():
                    todo.append((level - 1, ca[near], cb[near], acc[near]))


def _runs(sizes: np.ndarray, most: int) -> Iterator[slice]:
    total, begin = np.cumsum(sizes), 0
    while begin < len(sizes):
        done = total[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(total, done + most, "right")))
        yield slice(begin, end)
        begin = end


def forest(groups: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, root) for each linked fingerprint that is not its own root."""
    index = GrayIndex(groups, fps)
    label = np.arange(len(index.fps))
    for a, b in index.links():
        while True:
            la, lb = label[a], label[b]
            if (la == lb).all():
                break
            low = np.minimum(la, lb)
            np.minimum.at(label, la, low)
            np.minimum.at(label, lb, low)
            while (label[label] != label).any():
                label = label[label]
    moved = np.flatnonzero(label != np.arange(len(label)))
    return index.fps[moved], index.fps[label[moved]]


def _group_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by key; whole groups are searched together, about CHUNK / 4 rows at a time."""
    keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)

    def found(k: np.ndarray, f: np.ndarray) -> pa.RecordBatch:
        a, b = forest(k, f) if len(f) else (f, f)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    for batch in batches:
        keys = np.r_[keys, batch.column(0).to_numpy()]
        fps = np.r_[fps, batch.column(1).to_numpy().view(np.uint64)]
        if len(keys) >= CHUNK // 4:
            whole = int(np.searchsorted(keys, keys[-1]))
            if whole:
                yield found(keys[:whole], fps[:whole])
                keys, fps = keys[whole:], fps[whole:]
    yield found(keys, fps)


def _block(fp, i: int, bits: int):
    return F.shiftrightunsigned(fp, i * bits).bitwiseAND((1 << bits) - 1)


def _links(fps: DataFrame, hot: int) -> DataFrame:
    """Spanning links (a, b) of all fingerprints within the radius. fps: distinct `fp`."""
    fp = F.col("fp")
    pairs = list(combinations(range(4), 2))
    six = [F.lit(c << 32).bitwiseOR(F.shiftleft(_block(fp, i, 16), 16)).bitwiseOR(_block(fp, j, 16)) for c, (i, j) in enumerate(pairs)]
    keyed = fps.select(F.explode(F.array(*six)).alias("key"), "fp")
    counts = keyed.groupBy("key").count().where("count > 1")
    met = keyed.join(counts, "key")
    cold = met.where(F.col("count") <= hot).select("key", "fp")
    # The free half of a key: the two blocks that its combination does not fix; again two of four bytes agree.
    free = F.lit(None).cast("long")
    for c, pair in enumerate(pairs):
        i, j = sorted(set(range(4)) - set(pair))
        free = F.when(F.shiftrightunsigned("key", 32) == c, F.shiftleft(_block(fp, i, 16), 16).bitwiseOR(_block(fp, j, 16))).otherwise(free)
    hotter = met.where(F.col("count") > hot).withColumn("free", free)
    byte = F.col("free")
    finer = [F.xxhash64("key", F.lit(c), _block(byte, i, 8), _block(byte, j, 8)) for c, (i, j) in enumerate(pairs)]
    both = cold.unionByName(hotter.select(F.explode(F.array(*finer)).alias("key"), "fp"))
    return both.repartition("key").sortWithinPartitions("key").mapInArrow(_group_links, "a bigint, b bigint").distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node that has a smaller neighbour has one alone, which has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """node, root (the smallest node of its component) by alternating star contractions; one checkpoint a round.

    Links are few beside the rows that they come from: a checkpoint keeps about 500,000 in a partition."""
    edges = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    parts = pieces_for(edges.count(), 500_000)
    edges = edges.coalesce(parts)
    while not _stars(edges):
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*").where("u <> v").distinct()
        edges = cut(small.coalesce(parts))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def fingerprint_links(prints: DataFrame, hot: int = HOT) -> DataFrame:
    """a, b: for rows (node, fp), links of each node to the smallest of its fingerprint and of these along the index."""
    classes = prints.groupBy("fp").agg(F.min("node").alias("first"))
    same = prints.join(classes, "fp").where("node <> first").select(F.col("node").alias("a"), F.col("first").alias("b"))
    side = lambda k: classes.select(F.col("fp").alias(f"fp_{k}"), F.col("first").alias(k))
    found = _links(classes.select("fp"), hot).withColumnsRenamed({"a": "fp_a", "b": "fp_b"})
    return same.unionByName(found.join(side("a"), "fp_a").join(side("b"), "fp_b").select("a", "b"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", hot: int = HOT) -> DataFrame:
    """doc_id, fingerprint, component_id, component_size, links: one row for each row of `docs`.

    A null or wordless text has fingerprint zero, linked like any other; repeated rows share their
    fingerprint. component_id is the smallest non-null id that links reach, null if there is none.
    An empty table gives no rows.
    """
    prints = cut(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_fingerprints, "id bigint, fp bigint"))
    classes = prints.groupBy("fp").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    roots = components(_links(classes.select("fp"), hot))
    joined = classes.join(roots, classes.fp == roots.node, "left").select("fp", "first", "n", F.coalesce("root", "fp").alias("root"))
    whole = joined.groupBy("root").agg(F.min("first").alias("component_id"), F.sum("n").alias("component_size"))
    # A component with a great share of the distinct fingerprints may be split by adaptive execution.
    named = cut(joined.join(whole, "root").select("fp", "n", "component_id", "component_size"))
    return spread(prints, named, "fp", "n").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size")


def spread(rows: DataFrame, names: DataFrame, key: str, n: str, share: int = 1000) -> DataFrame:
    """rows joined with names on key. Keys with over 1/share of all rows, fewer than `share` of them, are broadcast."""
    total = names.agg(F.sum(n)).first()[0] or 0
    heavy = names.where(F.col(n) * share > total).drop(n)
    light = names.where(F.col(n) * share <= total).drop(n)
    hot_keys = F.broadcast(heavy)
    return rows.join(hot_keys, key).unionByName(rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))
