"""Near copies at a Jaccard similarity of 0.8 of five-word shingles, for the pipeline's stage.

SimHash proposes first: texts whose five-word fingerprints the Gray-order index links. At 0.8 two
fingerprints of 64 bits differ in about ten, far beyond what that index can search, so MinHash bands propose
the rest: texts of similarity s share one of BANDS keys of ROWS minima with probability 1 - (1 - s^5)^30,
which is 0.999993 at s = 0.8 and more above. No proposal counts unless the whole sets of shingles confirm it.

A first round confirms the SimHash links and one pair a text, with the smallest member of its bands, which
settles most of a large group in proportion to its size. What is left are bands with members of several
components. Chains of such bands make families; the sets of a family meet in tasks, in blocks of bounded
size so that a large family spreads, and a task compares all texts of different components by an inverted
index of its shingles. So every pair under a band is compared, and only the links that join components leave
a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bindery.llm.common import cut, release
from bindery.llm.simhash import components, fingerprint_links, majority, shingle_hashes

SHINGLE, BANDS, ROWS = 5, 30, 5
#: The least similarity, 0.8, in whole numbers.
SHARED, OF = 4, 5
#: Texts, and hashes of their shingles, in a block of a family.
BLOCK_TEXTS, BLOCK_HASHES = 1024, 1_000_000
_random = np.random.default_rng(42)
FLIPS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64)
FACTORS = _random.integers(0, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct XXH64 of all runs of five words; a shorter text is one shingle."""
    return np.unique(shingle_hashes(text, SHINGLE))


def band_keys(hashes: np.ndarray) -> np.ndarray:
    """One key for each band: its number and ROWS minima, mixed."""
    least = np.full(BANDS * ROWS, np.uint64(0xFFFFFFFFFFFFFFFF))
    for i in range(0, len(hashes), 1024):
        least = np.minimum(least, ((hashes[i : i + 1024, None] ^ FLIPS) * FACTORS).min(0))
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key


def _lists(found: list[np.ndarray]) -> pa.Array:
    offsets = np.r_[0, np.cumsum([len(f) for f in found])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array((np.concatenate(found) if found else np.empty(0, np.uint64)).view(np.int64)))


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """node, text -> node, fp, size of the set, keys of the bands."""
    release()
    for batch in batches:
        for s in range(0, batch.num_rows, 256):
            part = batch.slice(s, 256)
            fps, sizes, keys = [], [], []
            for text in part.column(1).to_pylist():
                h = shingle_hashes(text, SHINGLE)
                fps.append(majority(h) if text and text.strip() else 0)
                h = np.unique(h)
                sizes.append(len(h))
                keys.append(band_keys(h))
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(np.array(fps, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()), _lists(keys)], names=["node", "fp", "n", "keys"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    release()
    for batch in batches:
        for s in range(0, batch.num_rows, 256):
            part = batch.slice(s, 256)
            yield pa.RecordBatch.from_arrays([part.column(0), _lists([shingles(t) for t in part.column(1).to_pylist()])], names=["node", "hashes"])


def similar(shared, n, m):
    """Whether sets of n and m hashes with `shared` in common are similar enough."""
    return OF * shared >= SHARED * (n + m - shared)


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of the pairs (a, b) whose sets of shingles are similar enough."""
    named = pairs.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    side = lambda k: sets.select(F.col("node").alias(k), F.col("hashes").alias(f"set_{k}"))
    both = named.join(side("b"), "b").join(side("a"), "a")
    shared = F.size(F.array_intersect("set_a", "set_b"))
    return both.where(similar(shared, F.size("set_a"), F.size("set_b"))).select("a", "b")


def joining(nodes: np.ndarray, roots: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray]) -> list[tuple[int, int]]:
    """Similar pairs that join different roots, as few as do; of two blocks only pairs across them.

    A set that shares too few hashes with all others together is left out before pairs are looked at, and a
    set meets only those that hold one of its rarest hashes: as many of them as it can at most miss, and one."""
    many = len(np.unique(blocks)) > 1
    n = np.array([len(s) for s in sets])
    alive = np.ones(len(sets), bool)
    while True:
        own = np.repeat(np.flatnonzero(alive), n[alive])
        flat = np.concatenate([sets[k] for k in np.flatnonzero(alive)]) if alive.any() else np.empty(0, np.uint64)
        _, token, df = np.unique(flat, return_inverse=True, return_counts=True)
        common = np.bincount(own[df[token] > 1], minlength=len(sets))
        stay = alive & (OF * common >= SHARED * n)
        if stay.sum() == alive.sum():
            break
        alive = stay
    if alive.sum() < 2:
        return []
    rank = df[token]
    by_token = np.argsort(token, kind="stable")
    holders, first = own[by_token], np.cumsum(df) - df
    begin = np.zeros(len(sets), np.int64)
    begin[alive] = np.cumsum(n[alive]) - n[alive]
    _, label = np.unique(roots, return_inverse=True)
    root = {k: k for k in range(int(label.max()) + 1)}

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    largest = np.bincount(label[alive]).argmax()
    out = []
    for x in np.flatnonzero(alive):
        if label[x] == largest:
            continue  # its pairs are seen from the other side
        mine = token[begin[x] : begin[x] + n[x]]
        few = np.argsort(rank[begin[x] : begin[x] + n[x]], kind="stable")[: n[x] - -(-SHARED * n[x] // OF) + 1]
        near = np.unique(np.concatenate([holders[first[t] : first[t] + df[t]] for t in mine[few]]))
        near = near[(label[near] != label[x]) & (OF * np.minimum(n[near], n[x]) >= SHARED * np.maximum(n[near], n[x]))]
        near = near[blocks[near] != blocks[x]] if many else near
        near = near[[find(int(label[y])) != find(int(label[x])) for y in near]] if len(near) else near
        if not len(near):
            continue
        shared = np.bincount(np.concatenate([holders[first[t] : first[t] + df[t]] for t in mine]), minlength=len(sets))
        for y in near[similar(shared[near], n[x], n[near])]:
            a, b = find(int(label[x])), find(int(label[y]))
            if a != b:
                root[a] = b
                out.append((int(nodes[x]), int(nodes[y])))
    return out


def _family_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (group, block, node, root, hashes) come sorted by group; each group is compared as soon as it is whole."""

    def found(rows: list[tuple]) -> pa.RecordBatch:
        pairs = joining(np.array([r[2] for r in rows]), np.array([r[3] for r in rows]), np.array([r[1] for r in rows]), [r[4] for r in rows]) if len(rows) > 1 else []
        return pa.RecordBatch.from_arrays([pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows: list[tuple] = []
    for batch in batches:
        lists = batch.column(4)
        flat, offsets = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
        for k, (group, block, node, root) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(4)), strict=True)):
            if rows and rows[0][0] != group:
                yield found(rows)
                rows = []
            rows.append((group, block, node, root, flat[offsets[k] : offsets[k + 1]].copy()))
    yield found(rows)


def _blocks(members: DataFrame) -> DataFrame:
    """members (family, node, root, n) with group and block: a family over the size of a block meets in pairs of blocks."""
    size = members.groupBy("family").agg(F.count(F.lit(1)).alias("texts"), F.sum("n").alias("total"))
    parts = F.greatest(F.ceil(F.col("texts") / BLOCK_TEXTS), F.ceil(F.col("total") / BLOCK_HASHES), F.lit(1)).cast("int")
    dealt = members.join(size.select("family", parts.alias("parts")), "family").withColumn("block", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    # With several blocks the pairs inside one are held against each other in a group of that block alone.
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    spread = dealt.select("*", other)
    return spread.withColumn("group", F.xxhash64("family", F.least("block", "other"), F.greatest("block", "other")))


def near_components(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """node, root: components of two and more texts, linked at a similarity of 0.8. node is xxhash64 of the text."""
    texts = docs.select(node_of(text_col).alias("node"), F.col(text_col).alias("text"))
    keys = cut(texts.mapInArrow(_keys, "node bigint, fp bigint, n bigint, keys array<bigint>"))
    members = keys.select(F.explode("keys").alias("key"), "node", "n")
    shared = members.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.min("node").alias("first"), F.max("node").alias("last")).where("first < last")
    met = cut(members.join(shared.select("key", "first"), "key"))
    proposed = cut(fingerprint_links(keys.select("node", "fp")).unionByName(met.groupBy("node").agg(F.min("first").alias("first")).select(F.col("node").alias("a"), F.col("first").alias("b"))))
    nodes = met.select("node").union(proposed.select("a")).union(proposed.select("b")).distinct()
    sets = cut(texts.join(nodes, "node", "left_semi").dropDuplicates(["node"]).select("node", "text").mapInArrow(_sets, "node bigint, hashes array<bigint>"))
    links = cut(_confirmed(proposed, sets))
    roots = components(links)
    # Bands whose members are of several components, and the families that they chain together.
    labelled = met.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    open_bands = labelled.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("key", "low")
    left = cut(labelled.join(open_bands, "key").select("node", "n", "root", "low").distinct())
    chained = components(left.select(F.col("root").alias("a"), F.col("low").alias("b")))
    family = chained.select(F.col("node").alias("root"), F.col("root").alias("family"))
    inside = left.select("node", "n", "root").distinct().join(family, "root", "left").withColumn("family", F.coalesce("family", "root"))
    grouped = _blocks(inside).join(sets, "node").select("group", "block", "node", "root", "hashes")
    more = grouped.repartition("group").sortWithinPartitions("group").mapInArrow(_family_links, "a bigint, b bigint")
    roots = components(links.unionByName(more))
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())


def node_of(text_col: str = "text"):
    return F.xxhash64(F.coalesce(F.col(text_col), F.lit("")))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, that with the smallest id (null last); texts without a near copy stay.

    A null text counts as empty; texts without words are copies of each other; repeated rows are one text and
    stay once; ties of ids go to the text's hash; other columns, whatever their names, are handed on; an empty
    table gives no rows."""
    rows = docs.select(F.col("doc_id").alias("_id"), node_of().alias("_node"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"))
    roots = near_components(docs.select("text")).withColumnsRenamed({"node": "_node", "root": "_root"})
    rank = F.struct(F.col("_id").isNull().alias("no_id"), "_id", "_node")
    linked = rows.select("_id", "_node").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    best = linked.groupBy("_root").agg(F.min(rank).alias("best")).select("_root", "best")
    lost = linked.join(best, "_root").where(~rank.eqNullSafe(F.col("best"))).select(F.col("_id").alias("lost_id"), F.col("_node").alias("lost_node")).distinct()
    return rows.join(lost, (F.col("_node") == F.col("lost_node")) & F.col("_id").eqNullSafe(F.col("lost_id")), "left_anti").select("_row.*")
