"""Merkle manifest of a dataset by Pregel-style supersteps over RDDs.

Rows are hashed where they are read; only digests travel from there. Digests are sorted by source and id, and
each learns its place in its source from one small record for each range of the sort. In a superstep nodes send
their digest to their parent; a parent that has all children hashes them and is a node of the next superstep, until
each source has one node. The same supersteps make one root of these. Reverse supersteps start at the
root: each parent sends each child the path above it and the child's siblings, down to the leaves, where proofs are
written and checked.

A message is one digest, or one path for a parent of up to 16 leaves, and goes by a hash of (source, parent), so a
source with a third of all rows is spread like any other. The driver holds a record for each range of the
sort, never one for each source. Everything is a function of checkpointed digests, so what a lost
executor held is made again by Spark.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

from pyspark import RDD
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import cut, pieces_for, table

#: Children of a node.
FAN = 16
#: Nodes of a partition.
EACH = 50_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SCHEMA = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def encoded(value: Column) -> Column:
    """`-` for null, else UTF-8 byte count, colon, value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def digest(raw: bytes) -> bytes:
    """SHA-256 of digests that follow each other, written in hexadecimal."""
    return hashlib.sha256(raw.hex().encode()).digest()


def leaves(docs: DataFrame, tampered: Column, fields: tuple = FIELDS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """id, source, leaf, forged: digests of each row, and where `tampered` that of the row with A-Z in the text in lower case."""
    names = {c: F.col(f"`{c}`") for c in fields}
    hashed = lambda text: F.unhex(F.sha2(F.concat(*[encoded(text if c == text_col else v) for c, v in names.items()]), 256))
    forged = F.when(tampered, hashed(F.translate(names[text_col].cast("string"), UPPER, LOWER)))
    return docs.select(names[id_col].cast("long").alias("id"), names[source_col].cast("string").alias("source"), hashed(names[text_col]).alias("leaf"), forged.alias("forged"))


def _edge(part: int, rows: Iterator) -> Iterator[tuple]:
    """One record for a range of the sort: its first and last source with their rows in it, how many sources it has, and the rows of the largest."""
    first = last = None
    sources = most = 0
    for source, group in groupby(rows, lambda r: r["source"]):
        last = (source, sum(1 for _ in group))
        first = first or last
        sources += 1
        most = max(most, last[1])
    if first:
        yield part, first, last, sources, most


def places(edges: list[tuple]) -> tuple[dict, int, int]:
    """For each range: the number of its first source, the rows of it in ranges before, the rows in all of its first and its
    last source; then how many sources there are, and the rows of the largest."""
    known, total, at, most, before = {}, {}, -1, 0, None
    for part, (first, n_first), (last, n_last), sources, largest in edges:
        if at < 0 or first != before:
            at += 1
            total[at] = 0
        known[part] = (at, total[at], at + sources - 1)
        total[at] += n_first
        if sources > 1:
            at += sources - 1
            total[at] = n_last
        before, most = last, max(most, largest)
    return {p: (a, b, total[a], total[z]) for p, (a, b, z) in known.items()}, at + 1, max([most, *total.values()])


def _number(known: dict):
    def run(part: int, rows: Iterator) -> Iterator[tuple]:
        if part not in known:
            return
        number, before, n_first, n_last = known[part]
        groups = groupby(rows, lambda r: r["source"])
        held = list(next(groups)[1])
        first = True
        while held is not None:
            nxt = next(groups, None)
            n = n_first if first else n_last if nxt is None else len(held)
            for k, r in enumerate(held, before):
                yield number, k, n, bytes(r["leaf"]), (r["id"], r["forged"] and bytes(r["forged"]))
            number, before, first, held = number + 1, 0, False, nxt and list(nxt[1])

    return run


def climb(nodes: RDD, total: int, most: int) -> tuple[list[RDD], list[RDD]]:
    """Supersteps upward. `nodes`: (tree, place, nodes of its level, digest, payload) of the lowest level.

    Returns the runs of each level, ((tree, place of the parent), (nodes of the level, [(place, digest, payload)] in
    order)), and by level the roots, (tree, digest), of the trees that end there."""
    runs, roots = [], [nodes.context.emptyRDD()]
    while True:
        parts = pieces_for(total, EACH, 1)
        met = nodes.map(lambda x: ((x[0], x[1] // FAN), (x[1], x[2], x[3], x[4]))).groupByKey(parts)
        run = met.mapValues(lambda ms: (lambda s: (s[0][1], [(p, d, load) for p, _, d, load in s]))(sorted(ms, key=lambda m: m[0])))
        runs.append(run)
        up = run.map(lambda x: (*x[0], -(-x[1][0] // FAN), digest(b"".join(d for _, d, _ in x[1][1])) if x[1][0] > 1 else x[1][1][0][1], None))
        roots.append(up.filter(lambda x: x[2] == 1).map(lambda x: (x[0], x[3])))
        most, total = -(-most // FAN), -(-total // FAN)
        if most == 1:
            return runs, roots
        nodes = up.filter(lambda x: x[2] > 1)


def _lower(entry: tuple) -> Iterator[tuple]:
    """Each child of a run with its path: (left, right) digests of siblings, level by level, before the path of its parent."""
    (tree, _), (run, paths) = entry
    for path, known in paths:
        for n, children in run:
            raw = b"".join(d for _, d, _ in children)
            for k, (place, d, load) in enumerate(children):
                step = ((raw[: 32 * k], raw[32 * k + 32 :]),) if n > 1 else ()
                yield tree, place, d, load, step + path, known


def descend(runs: list[RDD], starts: list[RDD]) -> RDD:
    """Reverse supersteps. `starts`: by level, ((tree, 0), (path above the root, anything)) of the trees that end there.

    Returns (tree, place, digest, payload, path, anything) of the nodes of the lowest level."""
    paths = starts[-1]
    for level in range(len(runs), 0, -1):
        parts = runs[level - 1].getNumPartitions()
        met = runs[level - 1].cogroup(paths.partitionBy(parts), parts).flatMap(_lower)
        if level > 1:
            paths = met.map(lambda x: ((x[0], x[1]), (x[4], x[5]))).union(starts[level - 1])
    return met


def _proofs(entry: tuple) -> tuple:
    _, _, leaf, (doc_id, forged), path, (subroot, root) = entry
    proof = hashlib.sha256(b"".join(left + right for left, right in path).hex().encode()).hexdigest()
    at = forged or leaf
    for left, right in path:
        at = digest(left + at + right)
    return doc_id, leaf.hex(), subroot.hex(), root.hex(), proof, at.hex(), at == root


def manifest(docs: DataFrame, tampered: Column | None = None, fields: tuple = FIELDS, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row for each row of `docs`.

    Leaves ascend by id in each source, null ids first; rows of equal ids by their digest, equal rows in any order, as they
    give the same tree; a null source is a source and comes first. A row where `tampered` is true is verified
    with its text in lower case (A-Z only), which changes nothing where the text is null or has no such letter. A
    lone leaf is its source's subroot, a lone subroot the root. An empty table gives no rows. Only `fields` are
    read; texts never leave the task that reads them.
    """
    spark = docs.sparkSession
    rows = cut(leaves(docs, F.lit(False) if tampered is None else tampered, fields, id_col, source_col, text_col))
    total = rows.count()
    # Equal rows are told apart, so that a range of the sort can end among them; the digests are read from a checkpoint, so
    # that numbers come out alike whenever they are made again.
    order = [F.col("source").asc_nulls_first(), F.col("id").asc_nulls_first(), F.col("leaf").asc(), F.col("tie").asc()]
    dealt = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(pieces_for(total, EACH), *order).sortWithinPartitions(*order)
    sorted_rows = dealt.drop("tie").rdd
    known, sources, most = places(sorted(sorted_rows.mapPartitionsWithIndex(_edge).collect(), key=lambda e: e[0]))
    if not total:
        return spark.createDataFrame([], SCHEMA)
    runs, roots = climb(sorted_rows.mapPartitionsWithIndex(_number(known)), total, most)
    subroots = spark.sparkContext.union([r.map(lambda x, h=h: (0, x[0], sources, x[1], h)) for h, r in enumerate(roots) if h])
    top_runs, top_roots = climb(subroots, sources, sources)
    top = descend(top_runs, [r.map(lambda x: ((0, 0), ((), x[1]))) for r in top_roots])
    starts = [top.filter(lambda x, h=h: x[3] == h).map(lambda x: ((x[1], 0), (x[4], (x[2], x[5])))) for h in range(len(runs) + 1)]
    return spark.createDataFrame(descend(runs, starts).map(_proofs), SCHEMA.replace("doc_id", f"`{id_col}`"), verifySchema=False)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    return manifest(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)


ORACLE = r"""
with recursive
docs as (
  select doc_id, source, text,
    list_reduce([4294967295::bigint] || flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: [ord(c)::bigint, 0, 0, 0, 0, 0, 0, 0])),
      lambda a, x: case when (xor(a, x) & 1) = 1 then xor(xor(a, x) >> 1, 3988292384) else xor(a, x) >> 1 end) as c,
    coalesce(strlen(cast(doc_id as varchar)) || ':' || cast(doc_id as varchar), '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(cast(n_chars as varchar)) || ':' || cast(n_chars as varchar), '-') as head
  from documents),
leaves as (
  select doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) as leaf,
    case when xor(c, 4294967295) % 5 = 0 then sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) end as forged
  from docs),
placed as (
  select *, dense_rank() over (order by source nulls first) - 1 as g, count(*) over (partition by source) as n,
    row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx
  from leaves),
up as (
  select 0 as lvl, g, idx, n, leaf as h from placed
  union all
  select lvl + 1, g, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' order by idx)) from up where n > 1 group by lvl, g, idx // 16, n),
subroots as (select g, h from up where n = 1),
top as (
  select 0 as lvl, g as idx, (select count(*) from subroots) as n, h from subroots
  union all
  select lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(h, '' order by idx)) from top where n > 1 group by lvl, idx // 16, n),
nodes as (select 1 as tree, lvl, g, idx, n, h from up union all select 2, lvl, 0, idx, n, h from top),
steps as (
  select tree, lvl, g, idx, coalesce(string_agg(h, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
    coalesce(string_agg(h, '') over (w rows between 1 following and unbounded following), '') as r
  from nodes where n > 1 window w as (partition by tree, lvl, g, idx // 16 order by idx)),
fold as (
  select doc_id, leaf, g as own, g, idx as k, n, 1 as tree, 0 as lvl, idx as at, coalesce(forged, leaf) as h, '' as proof from placed
  union all
  select f.doc_id, f.leaf, f.own, f.g, f.k, (f.n + 15) // 16, 1, f.lvl + 1, f.at // 16, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  from fold f join steps s on s.tree = 1 and s.lvl = f.lvl and s.g = f.g and s.idx = f.at where f.n > 1),
high as (
  select doc_id, leaf, own, k, (select count(*) from subroots) as n, 0 as lvl, own as at, h, proof from fold where n = 1
  union all
  select f.doc_id, f.leaf, f.own, f.k, (f.n + 15) // 16, f.lvl + 1, f.at // 16, sha256(s.l || f.h || s.r), f.proof || s.l || s.r
  from high f join steps s on s.tree = 2 and s.lvl = f.lvl and s.idx = f.at where f.n > 1)
select doc_id, leaf, s.h as subroot, t.h as root, sha256(proof) as proof_sha256, high.h as folded_root, high.h = t.h as verified
from high join subroots s on s.g = own join top t on t.n = 1 where high.n = 1
"""
