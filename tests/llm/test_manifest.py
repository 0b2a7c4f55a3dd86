import hashlib
import zlib
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from bindery.llm import manifest
from bindery.llm.manifest import places
from cases import texts


def sha(s):
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def coded(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def lower(t):
    return t and "".join(c.lower() if "A" <= c <= "Z" else c for c in t)


def tree(hashes):
    """Root, and for each leaf the (left, right) siblings level by level."""
    paths, at, level = [[] for _ in hashes], list(range(len(hashes))), hashes
    while len(level) > 1:
        for k, p in enumerate(at):
            run = p // 16 * 16
            paths[k].append((level[run:p], level[p + 1 : run + 16]))
            at[k] = p // 16
        level = [sha("".join(level[s : s + 16])) for s in range(0, len(level), 16)]
    return level[0], paths


def brute(rows):
    by = defaultdict(list)
    for r in rows:
        by[r[1]].append((r, sha("".join(map(coded, r)))))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in sources:
        by[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = tree([h for _, h in by[s]])
    root, upper = tree([trees[s][0] for s in sources])
    for s, above in zip(sources, upper, strict=True):
        subroot, paths = trees[s]
        for (r, leaf), path in zip(by[s], paths, strict=True):
            path = path + above
            at = sha("".join(map(coded, [*r[:4], lower(r[4])]))) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 else leaf
            for left, right in path:
                at = sha("".join([*left, at, *right]))
            yield r[0], leaf, subroot, root, sha("".join("".join(a + b) for a, b in path)), at, at == root


def same(spark, rows, parts=5):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id bigint, source string, lang string, n_chars bigint, text string, leaf string, tie bigint").repartition(parts)
    got = manifest.manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))
    return got


def test_against_a_tree_built_at_once(spark, monkeypatch):
    monkeypatch.setattr(manifest, "EACH", 40)  # many ranges, so that sources begin and end within and between them
    odd = [(i, None if i is None else "ü" if i % 2 else "", "de", len(t or "") if i != 3 else None, t) for i, t in texts() if t is None or len(t) < 1000]
    hot = [(i, "hot", None, 1, f"Text {i}") for i in range(300)]
    exact = [(1000 + i, f"s{n}", "en", n, f"T {i} É") for n in (1, 2, 15, 16, 17, 256, 257) for i in range(n)]
    copies = [(None, "again", "en", 4, "Same")] * 150
    tied = [(7, "tie", "en", 1, t) for t in "abcABC"]
    same(spark, [*odd, *hot, *exact, *copies, *tied])


def test_one_leaf_one_source_many_sources_and_no_rows(spark):
    same(spark, [(1, None, None, None, None)])
    same(spark, [(i, "only", "en", 1, "Ab") for i in range(18)])
    same(spark, [(i, f"s{i}", "en", 1, "Ab") for i in range(18)])
    empty = spark.createDataFrame([], "doc_id bigint, source string, lang string, n_chars bigint, text string")
    assert manifest.manifest(empty).count() == 0
    assert manifest.manifest(spark.createDataFrame([(1, "a", "b", 1, "T")], empty.schema)).first()["verified"]


def test_places_of_sources_over_ranges():
    edges = [(0, ("a", 3), ("b", 2), 2, 3), (1, ("b", 5), ("b", 5), 1, 5), (3, ("b", 1), ("d", 4), 3, 4)]
    known, sources, most = places(edges)
    assert (sources, most) == (4, 8)
    assert known == {0: (0, 0, 3, 8), 1: (1, 2, 8, 8), 3: (1, 7, 8, 4)}
