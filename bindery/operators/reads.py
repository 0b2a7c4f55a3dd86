"""Operators over reads and alignments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.functions.sequences import mapped_span, md_mismatches, revcomp


def deduplicate(reads: DataFrame, order: str = "read_id") -> DataFrame:
    """The first read of each sequence. Rows of a hot sequence are reduced before the shuffle."""
    rest = [c for c in reads.columns if c not in ("seq", order)]
    best = reads.groupBy("seq").agg(F.min(F.struct(order, *rest)).alias("b"))
    return best.select(F.col(f"b.{order}"), "seq", *[F.col(f"b.{c}") for c in rest])


def duplicate_histogram(reads: DataFrame) -> DataFrame:
    """multiplicity, sequences."""
    return reads.groupBy("seq").agg(F.count(F.lit(1)).alias("multiplicity")).groupBy("multiplicity").agg(F.count(F.lit(1)).alias("sequences"))


def length_ecdf(reads: DataFrame) -> DataFrame:
    """length, n, ecdf; the window runs over distinct lengths."""
    n = reads.groupBy(F.length("seq").cast("long").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    w = Window.orderBy("length").rowsBetween(Window.unboundedPreceding, 0)
    return n.crossJoin(F.broadcast(total)).withColumn("ecdf", F.sum("n").over(w) / F.col("total")).drop("total")


def drop_reason(min_quality: int, min_mean: float, min_length: int) -> Column:
    """First failing check in a fixed order, null for good reads. Columns: mapped, seq, quals, cigar."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    mean = F.aggregate("quals", F.lit(0.0), lambda a, q: a + q) / F.size("quals")
    return (
        F.when(~F.col("mapped"), "unmapped").when(F.col("seq").contains("N"), "contains_n").when(F.array_min("quals") < min_quality, "low_quality")
        .when(mean < min_mean, "low_mean_quality").when(end - left < min_length, "short")
    )


def read_qc(align: DataFrame, min_quality: int = 0, min_mean: float = 20, min_length: int = 20) -> DataFrame:
    """reason, reads; good reads as "kept"."""
    return align.groupBy(F.coalesce(drop_reason(min_quality, min_mean, min_length), F.lit("kept")).alias("reason")).agg(F.count(F.lit(1)).alias("reads"))


def mismatches(align: DataFrame) -> DataFrame:
    """One row per mismatch: read_id, length, mm_pos, transition (reference and read base), quality, fwd."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    rows = align.withColumn("left", left).withColumn("length", (end - left).cast("long")).select("*", F.explode(md_mismatches(F.col("md"))).alias("m"))
    at = (F.col("left") + F.col("m.pos") + 1).cast("int")
    ref, read = F.col("m.ref"), F.substring(F.col("seq"), at, F.lit(1))
    bases = F.when(F.col("fwd"), F.concat(ref, read)).otherwise(F.concat(revcomp(ref), revcomp(read)))
    pos = F.when(F.col("fwd"), F.col("m.pos")).otherwise(F.col("length") - 1 - F.col("m.pos"))
    return rows.select("read_id", "length", pos.alias("mm_pos"), bases.alias("transition"), F.try_element_at("quals", at).alias("quality"), "fwd")


def mismatch_filter(align: DataFrame, min_quality: int, max_mismatches: int, edge: int) -> DataFrame:
    """Reads without mismatches, or with good, few mismatches outside the edges (those within `edge` are clipped, not counted)."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    mm = md_mismatches(F.col("md"))
    inner = F.filter(mm, lambda m: (m["pos"] >= edge) & (m["pos"] < end - left - edge))
    bad = F.exists(mm, lambda m: F.try_element_at(F.col("quals"), (left + m["pos"] + 1).cast("int")) < min_quality)
    return align.where((F.col("nm") == 0) | (~bad & (F.size(inner) <= max_mismatches)))


def edge_mutations(align: DataFrame, edge: int) -> DataFrame:
    """Reads whose first mismatch lies inside [edge, length - edge); reads without a mismatch are dropped."""
    first = F.get(md_mismatches(F.col("md")), F.lit(0))["pos"]
    return align.where((F.col("nm") > 0) & (first >= edge) & (first < F.length("seq") - edge))


def clip_edges(align: DataFrame, edge: int) -> DataFrame:
    """Reads with mismatches near an edge soft-clipped there: seq stays, start moves, cigar, md and nm follow.

    Insertions, deletions and skips stay; what is clipped has to lie in the first and the last match block and leave a letter of each.
    Reads where it does not, or that do not begin and end with a match beside soft clips, are left alone."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    size, mm, at = F.col("_size"), F.col("_mm"), lambda m: m["pos"]
    cut_left = F.coalesce(F.array_max(F.transform(F.filter(mm, lambda m: m["pos"] < edge), at)) + 1, F.lit(0))
    cut_right = size - F.coalesce(F.array_min(F.transform(F.filter(mm, lambda m: m["pos"] >= size - edge), at)), size)
    step1 = align.withColumns({"_left": left, "_right": F.length("seq") - end, "_size": end - left, "_mm": md_mismatches(F.col("md"))})
    step2 = step1.withColumns({"_cl": cut_left, "_cr": cut_right})
    rest = F.filter(mm, lambda m: (m["pos"] >= F.col("_cl")) & (m["pos"] < size - F.col("_cr")))
    step3 = step2.withColumn("_rest", rest).withColumn("_last", F.size("_rest"))
    # The tag is the gaps between the mismatches that are left and the mismatches themselves.
    gap = lambda m, i: m["pos"] - F.when(i > 0, F.get(F.col("_rest"), i - 1)["pos"] + 1).otherwise(F.col("_cl"))
    tail = size - F.col("_cr") - F.coalesce(F.get("_rest", F.col("_last") - 1)["pos"] + 1, F.col("_cl"))
    md = F.concat(F.concat_ws("", F.transform("_rest", lambda m, i: F.concat(gap(m, i).cast("string"), m["ref"]))), tail.cast("string"))
    s, e, kept = F.col("_left") + F.col("_cl"), F.col("_right") + F.col("_cr"), size - F.col("_cl") - F.col("_cr")
    cigar = F.concat(F.when(s > 0, F.concat(s.cast("string"), F.lit("S"))).otherwise(""), kept.cast("string"), F.lit("M"), F.when(e > 0, F.concat(e.cast("string"), F.lit("S"))).otherwise(""))
    simple = F.col("cigar").rlike(r"^(\d+S)?\d+M(\d+S)?$") & (kept > 0)
    new = {"start": F.col("start") + F.col("_cl"), "cigar": cigar, "md": md, "nm": F.col("_last")}
    gapped = F.col("cigar").rlike(GAPPED) & F.col("nm").isNotNull() & F.col("md").rlike("^[0-9]+")
    simply = step3.where(~F.coalesce(gapped, F.lit(False))).withColumns({k: F.when(simple, v).otherwise(F.col(k)) for k, v in new.items()}).select(align.columns)
    return simply.unionByName(_clip_gapped(align.where(gapped), edge))


#: Soft clips, a match block, anything, a match block, soft clips.
GAPPED = r"^(?:(\d+)S)?(\d+)M((?:\d+[A-Z=])*\d+[IDN](?:\d+[A-Z=])*?)(\d+)M(?:(\d+)S)?$"


def _clip_gapped(align: DataFrame, edge: int) -> DataFrame:
    """The same for reads of several match blocks. A clip ends with a mismatch, so the tag loses its parts up to that one, and from
    that one on."""
    number = lambda k: F.coalesce(F.regexp_extract("cigar", GAPPED, k).try_cast("int"), F.lit(0))
    parts = F.regexp_extract_all("md", F.lit(r"[0-9]+|\^[A-Z]+|[A-Z]"), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<text:string,at:int>>").alias("out"))

    def step(a, p):
        """Each part with the letters of the match blocks before it, -1 where it is no mismatch."""
        plain, gone = p.rlike("^[0-9]"), p.startswith("^")
        here = F.struct(p.alias("text"), F.when(plain | gone, -1).otherwise(a["at"]).alias("at"))
        return F.struct((a["at"] + F.when(plain, p.try_cast("int")).when(gone, 0).otherwise(1)).alias("at"), F.concat(a["out"], F.array(here)).alias("out"))

    walked = align.withColumns({"_w": F.aggregate(parts, zero, step), "_s": number(1), "_m": number(2), "_n": number(4), "_e": number(5)})
    hits = F.filter("_w.out", lambda x: x["at"] >= 0)
    known = walked.withColumns({
        "_cl": F.coalesce(F.array_max(F.transform(F.filter(hits, lambda x: x["at"] < edge), lambda x: x["at"])) + 1, F.lit(0)),
        "_from": F.coalesce(F.array_min(F.transform(F.filter(hits, lambda x: x["at"] >= F.col("_w.at") - edge), lambda x: x["at"])), F.col("_w.at")),
    }).withColumn("_cr", F.col("_w.at") - F.col("_from"))
    begin = F.when(F.col("_cl") > 0, F.array_position(F.transform("_w.out", lambda x: x["at"]), F.col("_cl") - 1)).otherwise(0)
    stop = F.when(F.col("_cr") > 0, F.array_position(F.transform("_w.out", lambda x: x["at"]), F.col("_from"))).otherwise(F.size("_w.out") + 1)
    kept = known.withColumn("_rest", F.slice("_w.out", (begin + 1).cast("int"), F.greatest(stop - begin - 1, F.lit(0)).cast("int")))
    clip = lambda c: F.when(c > 0, F.concat(c.cast("string"), F.lit("S"))).otherwise("")
    block = lambda c: F.concat(c.cast("string"), F.lit("M"))
    cigar = F.concat(clip(F.col("_s") + F.col("_cl")), block(F.col("_m") - F.col("_cl")), F.regexp_extract("cigar", GAPPED, 3), block(F.col("_n") - F.col("_cr")), clip(F.col("_e") + F.col("_cr")))
    lost = F.size(hits) - F.size(F.filter("_rest", lambda x: x["at"] >= 0))
    new = {"start": F.col("start") + F.col("_cl"), "cigar": cigar, "md": F.concat_ws("", "_rest.text"), "nm": F.col("nm") - lost}
    fits = (F.col("_cl") < F.col("_m")) & (F.col("_cr") < F.col("_n"))
    return kept.withColumns({k: F.when(fits, v).otherwise(F.col(k)) for k, v in new.items()}).select(align.columns)


def mismatch_profile(mm: DataFrame, reads_per_length: int = 20) -> DataFrame:
    """length, mm_pos and one count for each of the 12 transitions, of lengths with enough mismatches."""
    pairs = [a + b for a in "ACGT" for b in "ACGT" if a != b]
    enough = mm.groupBy("length").agg(F.count(F.lit(1)).alias("c")).where(F.col("c") >= F.col("length") * reads_per_length).select("length")
    return mm.join(F.broadcast(enough), "length").groupBy("length", "mm_pos").agg(*[F.count_if(F.col("transition") == p).alias(p) for p in pairs])  # at most one row a length is broadcast


def transition_share(mm: DataFrame, by: str, transition: str = "TC") -> DataFrame:
    """Share of a transition among mismatches by quality or length."""
    return mm.groupBy(by).agg(F.avg((F.col("transition") == transition).cast("double")).alias("share"), F.count(F.lit(1)).alias("n"))


def softclips(align: DataFrame, n: int) -> DataFrame:
    """clip_len, seq, count, rank: the n most frequent 5' clipped sequences of each length, ties by sequence."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    clip = F.when(F.col("fwd"), F.substring(F.col("seq"), F.lit(1), left)).otherwise(revcomp(F.substring(F.col("seq"), end + 1, F.length("seq"))))
    c = align.select(clip.alias("clip")).where("clip <> ''").groupBy(F.length("clip").cast("long").alias("clip_len"), F.col("clip").alias("seq")).agg(F.count(F.lit(1)).alias("count"))
    w = Window.partitionBy("clip_len").orderBy(F.col("count").desc(), "seq")
    return c.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= n)


def flip_mates(align: DataFrame) -> DataFrame:
    """Proper pairs with the strand flag of the second mate flipped (0x10 there, 0x20 on the first)."""
    flag = F.col("flag")
    return align.where(flag.bitwiseAND(2) != 0).withColumn("flag", flag.bitwiseXOR(F.when(flag.bitwiseAND(128) != 0, 16).otherwise(32)))


def statistics(align: DataFrame) -> DataFrame:
    """total_reads, total_coverage of mapped reads."""
    left, end = mapped_span(F.col("cigar"), F.length("seq"))
    return align.where("mapped").agg(F.count(F.lit(1)).alias("total_reads"), F.coalesce(F.sum((end - left).cast("long")), F.lit(0).cast("long")).alias("total_coverage"))


def left_over(reads: DataFrame, align: DataFrame, name: str = "id") -> DataFrame:
    """Reads that no alignment maps, for the next mapper. Names are compared up to the first white space, as mappers write them."""
    mapped = align.where("mapped").select(F.col("read_id").cast("string").alias("_mapped")).distinct()
    return reads.withColumn("_name", F.regexp_extract(F.col(name).cast("string"), r"^\S*", 0)).join(mapped, F.col("_name") == F.col("_mapped"), "left_anti").drop("_name")


def merge_runs(first: DataFrame, later: DataFrame) -> DataFrame:
    """Alignments of two mappers: all mapped ones of both; of reads that neither maps, the rows of the first, or of the later one if the
    first does not know them. Columns of the first."""
    both = first.unionByName(later.select(*[F.col(c) if c in later.columns else F.lit(None).cast(t).alias(c) for c, t in first.dtypes]))
    mapped, known = both.where("mapped").select("read_id").distinct(), first.select("read_id").distinct()
    lost = first.where("not mapped").unionByName(both.where("not mapped").join(known, "read_id", "left_anti").select(first.columns))
    return both.where("mapped").unionByName(lost.join(mapped, "read_id", "left_anti").select(first.columns))
