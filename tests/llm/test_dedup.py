import hashlib
import re

import numpy as np
import pytest
import xxhash

from bindery.llm.exact_dedup import exact_groups
from bindery.llm.simhash import GrayIndex, components, fingerprint, near_groups
from cases import frame, texts


def norm(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


def test_exact_groups(spark):
    rows = texts()
    got = exact_groups(frame(spark, rows), salts=3).collect()
    groups = {}
    for i, t in rows:
        groups.setdefault(norm(t), []).append(i)
    assert len(got) == len(rows)
    want = {(i, min((x for x in g if x is not None), default=None), len(g), hashlib.sha256(k.encode()).hexdigest()) for k, g in groups.items() for i in g}
    assert {(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got} == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_groups_empty_and_hot(spark):
    assert exact_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    rows = [(i, "same text") for i in range(500)]
    got = exact_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)).collect()
    assert {(r.keep_id, r.group_size) for r in got} == {(0, 500)} and [r.doc_id for r in got if r.kept] == [0]


def test_copies_without_ids_spread_over_salts(spark):
    """A third of all rows is one text under null ids: its batches go to many salts, and no salt holds most of them."""
    from bindery.llm.exact_dedup import LOCAL, _local

    rows = [(None, "same text") if i % 3 == 0 else (i, f"text {i}") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")
    try:
        lists = docs.mapInArrow(_local(64), LOCAL).where("norm = 'same text'").groupBy("salt").count().collect()
        got = exact_groups(docs).collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(lists) > 32 and max(x["count"] for x in lists) * 8 < sum(x["count"] for x in lists)
    hot = [x for x in got if x.doc_id is None]
    assert len(hot) == 2000 and {(x.keep_id, x.group_size) for x in hot} == {(None, 2000)} and sum(x.kept for x in hot) == 1
    assert sum(x.kept for x in got) == 4001


def brute_print(t):
    w = (t or "").encode().lower().split()
    s = [b" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(x, 42) for x in s]
    return sum(1 << b for b in range(64) if sum(x >> b & 1 for x in h) * 2 > len(h))


def brute_components(fps):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 2:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprint_is_the_stated_one(spark):
    for _, t in texts():
        assert fingerprint(t) == brute_print(t)
    assert spark.sql("select xxhash64('a b c') h").first().h == np.uint64(xxhash.xxh64_intdigest(b"a b c", 42)).astype(np.int64)


@pytest.mark.parametrize("hot", [2, 4096])
def test_near_groups(spark, hot):
    rows = texts(2) + [(200 + i, " ".join(f"w{j}" for j in range(400) if j != i * 40)) for i in range(9)]
    got = near_groups(frame(spark, rows), hot=hot).collect()
    assert len(got) == len(rows)
    fps = [brute_print(t) for _, t in rows]
    label = brute_components(fps)
    low = {}
    for (i, _), c in zip(rows, label, strict=True):
        if i is not None:
            low[c] = min(low.get(c, i), i)
    want = sorted((str(i), f"{f:016x}", str(low.get(c))) for (i, _), f, c in zip(rows, fps, label, strict=True))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_gray_index_finds_every_pair():
    rng = np.random.default_rng(0)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 40, dtype=np.uint64)) for _ in range(12)] + [seeds]))
    for groups in (np.zeros(len(fps), np.int64), (fps % np.uint64(3)).astype(np.int64)):
        index = GrayIndex(groups, fps)
        got = {frozenset((int(index.fps[a]), int(index.fps[b]))) for x, y in index.links() for a, b in zip(x, y, strict=True)}
        want = {frozenset((int(a), int(b))) for k, a in enumerate(fps) for j, b in enumerate(fps) if j < k and groups[k] == groups[j] and (int(a) ^ int(b)).bit_count() <= 2}
        assert got == want and want


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 99), (7, 3)], "a bigint, b bigint")
    got = {r.node: r.root for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 41)}, 100: 99}
    assert near_groups(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
