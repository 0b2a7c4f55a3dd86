"""Genomic views derived from the star-schema tables, in SQL that Spark and DuckDB share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("lineitem", "orders", "documents")
_CHROM = "case o_orderstatus when 'F' then 'chrA' when 'O' then 'chrN' else 'chrR' end"
_COUNTS = """select chrom, pos, case ref when 'T' then '+' else '-' end as strand,
  cast(case ref when 'T' then length(bases) - length(replace(bases, 'C', '')) else length(bases) - length(replace(bases, 'g', '')) end as bigint) as k,
  cast(case ref when 'T' then length(bases) - length(replace(replace(bases, 'C', ''), '.', '')) else length(bases) - length(replace(replace(bases, 'g', ''), ',', '')) end as bigint) as n
  from {} where ref in ('A', 'T')"""

VIEWS = {
    "v_sites": """select concat('chr', l_returnflag) as seqid, cast(l_orderkey * 4 + l_linenumber as bigint) as position, cast(l_linenumber as int) as transitions,
  cast(l_quantity as int) + l_linenumber as coverage, l_extendedprice as score, case when l_linestatus = 'F' then '+' else '-' end as strand,
  round(l_linenumber / (l_quantity + l_linenumber), 6) as occupancy, l_partkey as tie1, l_suppkey as tie2 from lineitem""",
    "v_annots": f"""select o_orderkey as annot_id, {_CHROM} as seqid, cast(o_orderkey * 4 + 1 as bigint) as start_pos, cast(o_orderkey * 4 + 1 + o_custkey % 120 as bigint) as end_pos,
  case when o_custkey % 2 = 0 then '+' else '-' end as strand, o_orderpriority as feature from orders""",
    "v_pileup": f"""select {_CHROM} as chrom, cast(o_orderkey + 1 as bigint) as pos, substr('ACGT', cast(o_custkey % 4 + 1 as int), 1) as ref,
  concat(repeat('.', cast(o_orderkey % 17 as int)), repeat('C', cast(o_custkey % 5 as int)), repeat(',', cast(o_orderkey % 13 as int)), repeat('g', cast(o_custkey % 3 as int)), repeat('A', cast(o_orderkey % 2 as int))) as bases from orders""",
    "v_mock_pileup": f"""select {_CHROM} as chrom, cast(o_orderkey + 1 as bigint) as pos, substr('ACGT', cast(o_custkey % 4 + 1 as int), 1) as ref,
  concat(repeat('.', cast(o_custkey % 11 as int)), repeat('C', cast(o_orderkey % 3 as int)), repeat(',', cast(o_custkey % 7 as int)), repeat('g', cast(o_orderkey % 2 as int))) as bases from orders where o_orderkey % 5 <> 0""",
    "v_factor": _COUNTS.format("v_pileup"),
    "v_mock": _COUNTS.format("v_mock_pileup"),
    "v_genome": "select cast(doc_id as varchar(20)) as seqid, regexp_replace(upper(text), '[^ACGT]', ''{g}) as seq from documents",
    "v_reads": "select cast(seqid as bigint) as read_id, concat('GATC', substr(seq, 1, 40), 'TGGAATTC', substr(seq, 41, 5)) as seq from v_genome where length(seq) >= 20",
    "v_trtable": """select u.chrom, u.pos, cast(coalesce(f.k, 0) as bigint) as k_factor, cast(coalesce(f.n, 0) as bigint) as n_factor, cast(coalesce(m.k, 0) as bigint) as k_mock, cast(coalesce(m.n, 0) as bigint) as n_mock, u.strand
  from (select chrom, pos, strand from v_factor) u left join v_factor f on u.chrom = f.chrom and u.pos = f.pos and u.strand = f.strand left join v_mock m on u.chrom = m.chrom and u.pos = m.pos and u.strand = m.strand""",
    "v_align0": """select o_orderkey as read_id, cast(30 + o_custkey % 11 as int) as len, cast(o_custkey % 4 as int) as s, cast(o_orderkey % 3 as int) as e, cast(o_orderkey % 20 as int) as p,
  case when o_custkey % 3 = 0 then 1 else 0 end as nm, o_orderkey % 17 <> 0 as mapped, o_custkey % 2 = 0 as fwd, o_orderkey, cast(o_orderkey * 4 as bigint) as start,
  cast(2 + case when o_custkey % 2 = 0 then 0 else 16 end + case when o_orderkey % 2 = 0 then 64 else 128 end as int) as flag from orders""",
    "v_align": """select read_id, len, s, e, p, nm, mapped, fwd, start, flag, o_orderkey,
  concat(case when o_orderkey % 23 = 0 then 'N' else 'A' end, substr(repeat('ACGTTGCA', 8), cast(1 + o_orderkey % 8 as int), len - 1)) as seq,
  concat(case when s > 0 then concat(cast(s as varchar(9)), 'S') else '' end, cast(len - s - e as varchar(9)), 'M', case when e > 0 then concat(cast(e as varchar(9)), 'S') else '' end) as cigar,
  case when nm = 1 then concat(cast(p as varchar(9)), 'T', cast(len - s - e - p - 1 as varchar(9))) else cast(len - s - e as varchar(9)) end as md from v_align0""",
    "v_indel0": """select o_orderkey as read_id, cast(o_orderkey % (select count(*) from documents) as varchar(20)) as chrom, cast(1 + (o_custkey * 7 + o_orderkey) % 300 as bigint) as start, o_custkey % 2 = 0 as fwd,
  cast(o_custkey % 3 as int) as s, cast(5 + o_orderkey % 9 as int) as a, cast(o_custkey % 4 as int) as d, cast(4 + o_custkey % 7 as int) as b, cast(o_orderkey % 3 as int) as i, cast(3 + o_orderkey % 5 as int) as c,
  cast(case when o_custkey % 10 = 0 then 25 else 0 end as int) as n, cast(case when o_custkey % 10 = 0 then 4 else 0 end as int) as t, cast(o_orderkey % 4 as int) as e, cast(1 + o_orderkey % 10 as int) as f, o_orderkey,
  cast(o_custkey % 5 * 10 as int) as mapq, concat(substr('ACGT', cast(1 + o_custkey % 4 as int), 1), substr('ACGT', cast(1 + o_custkey % 23 % 2 as int), 1), substr('ACGT', cast(1 + o_orderkey % 2 as int), 1), 'AC', substr('ACGT', cast(1 + o_orderkey % 7 % 3 as int), 1)) as umi from orders""",
    "v_indel": """select *, substr(repeat('ACGTTGCAGT', 10), f, s + a + b + i + c + t + e) as seq,
  concat(case when s > 0 then concat(cast(s as varchar(9)), 'S') else '' end, cast(a as varchar(9)), 'M', case when d > 0 then concat(cast(d as varchar(9)), 'D') else '' end, cast(b as varchar(9)), 'M',
    case when i > 0 then concat(cast(i as varchar(9)), 'I') else '' end, cast(c as varchar(9)), 'M', case when n > 0 then concat(cast(n as varchar(9)), 'N4M') else '' end, case when e > 0 then concat(cast(e as varchar(9)), 'S') else '' end) as cigar
  from v_indel0""",
}


def views(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """DataFrames of all views, built without registering names for callers."""
    out: dict[str, DataFrame] = {}
    for t in TABLES:
        spark.read.parquet(f"{sf_dir}/{t}.parquet").createOrReplaceTempView(t)
    for name, sql in VIEWS.items():
        out[name] = spark.sql(sql.replace("{g}", ""))
        if name == "v_genome":  # the same letters: runs of others leave in one match, not letter by letter, and before upper, which makes ST of a ligature
            out[name] = spark.table("documents").select(F.col("doc_id").cast("varchar(20)").alias("seqid"), F.upper(F.regexp_replace("text", "[^ACGTacgt]+", "")).alias("seq"))
        out[name].createOrReplaceTempView(name)
    out["documents"] = spark.table("documents")
    out["v_align"] = out["v_align"].selectExpr("*", "transform(sequence(0, len - 1), i -> cast(15 + (o_orderkey + i * 7) % 26 as int)) as quals")
    out["v_indel"] = out["v_indel"].selectExpr("*", "transform(sequence(0, length(seq) - 1), j -> cast(15 + (o_orderkey + j * 7) % 26 as int)) as quals")
    return out


def with_views(sql: str) -> str:
    """A DuckDB statement: `sql` is a SELECT, or further common tables, begun with a comma, and a SELECT."""
    ctes = ", ".join(f"{name} as ({body.replace('{g}', chr(44) + ' ' + chr(39) + 'g' + chr(39))})" for name, body in VIEWS.items())
    return f"with recursive {ctes} {sql}"
