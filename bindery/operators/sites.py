"""Site tables: callers, filters, annotation, order, normalisation, quantiles, neighbourhood."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators.intervals import point_join
from bindery.operators.lineage import cut
from bindery.operators.neighbours import next_distance, next_distance_exact  # noqa: F401

SITE_KEYS = (("seqid", "a_seqid"), ("strand", "a_strand"))


def renamed(annots: DataFrame) -> DataFrame:
    """Annotations with key names that sites do not have."""
    return annots.withColumnsRenamed({"seqid": "a_seqid", "strand": "a_strand"})


def overlapping(sites: DataFrame, annots: DataFrame, how: str = "left_semi", extend: int = 0) -> DataFrame:
    """Sites inside (left_semi) or outside (left_anti) same-strand annotations widened by `extend`."""
    return point_join(sites, renamed(annots), SITE_KEYS, how, low=F.col("start_pos") - extend, high=F.col("end_pos") + extend)


def filter_features(sites: DataFrame, annots: DataFrame, features: list[str], padding: int = 0, ignore_seqid: bool = False) -> DataFrame:
    """Sites without a same-strand annotation of the features within `padding`; no features remove nothing.

    ignore_seqid matches positions on any sequence, as older tools did."""
    some = renamed(annots.where(F.col("feature").isin(features)))
    on = SITE_KEYS[1:] if ignore_seqid else SITE_KEYS
    return point_join(sites, some, on, "left_anti", low=F.col("start_pos") - padding, high=F.col("end_pos") + padding)


def removed_by_feature(sites: DataFrame, annots: DataFrame, features: list[str], ident: list[str], padding: int = 0) -> DataFrame:
    """feature, removed: each removed site counts for its first annotation by start, then end, then feature."""
    some = renamed(annots.where(F.col("feature").isin(features)))
    hits = point_join(sites, some, SITE_KEYS, "inner", low=F.col("start_pos") - padding, high=F.col("end_pos") + padding)
    first = hits.groupBy(*ident).agg(F.min(F.struct("start_pos", "end_pos", "feature"))["feature"].alias("feature"))
    return first.groupBy("feature").agg(F.count(F.lit(1)).alias("removed"))


def annotate(sites: DataFrame, annots: DataFrame, ident: list[str], max_n: int | None = None) -> DataFrame:
    """`ident` columns of all sites with `annotation`: the distinct features around them, sorted, joined by "|", or NA.

    Rows keep their number, repeated ones too, and may hold nulls; a site without position, sequence or strand is
    NA. max_n takes the sites of largest occupancy, ties in order of `ident`. Features are collected for each different place,
    three columns wide, and joined back to the sites by it."""
    rows = sites.select(*ident)
    if max_n is not None:
        rows = rows.orderBy(F.col("occupancy").desc_nulls_last(), *ident).limit(max_n)
    place = ["seqid", "strand", "position"]
    hits = point_join(rows.select(*place).distinct(), renamed(annots).select("a_seqid", "a_strand", "start_pos", "end_pos", "feature"), SITE_KEYS)
    named = hits.groupBy(*place).agg(F.concat_ws("|", F.sort_array(F.collect_set("feature"))).alias("annotation"))
    return rows.join(named, place, "left").select(*ident, F.when(F.coalesce("annotation", F.lit("")) == "", "NA").otherwise(F.col("annotation")).alias("annotation"))


def annotation_summary(annotated: DataFrame) -> DataFrame:
    """kind, sites: unannotated, ambiguous (several features) or the one feature."""
    kind = F.when(F.col("annotation") == "NA", "unannotated").when(F.col("annotation").contains("|"), "ambiguous").otherwise(F.col("annotation"))
    return annotated.groupBy(kind.alias("kind")).agg(F.count(F.lit(1)).alias("sites"))


def inside(sites: DataFrame, annots: DataFrame, upstream: int, downstream: int) -> DataFrame:
    """Sites in annotations widened upstream and downstream by strand."""
    plus = F.col("a_strand") == "+"
    low = F.col("start_pos") - F.when(plus, upstream).otherwise(downstream)
    high = F.col("end_pos") + F.when(plus, downstream).otherwise(upstream)
    return point_join(sites, renamed(annots), SITE_KEYS, "left_semi", low=low, high=high)


def around(sites: DataFrame, annots: DataFrame, anchor: str, upstream: int, downstream: int) -> DataFrame:
    """Sites in a window around the start or stop of annotations, mirrored on the minus strand."""
    plus = F.col("a_strand") == "+"
    at = F.when(plus == F.lit(anchor == "start"), F.col("start_pos")).otherwise(F.col("end_pos"))
    low, high = at - F.when(plus, upstream).otherwise(downstream), at + F.when(plus, downstream).otherwise(upstream)
    return point_join(sites, renamed(annots), SITE_KEYS, "left_semi", low=low, high=high)


def antisense(sites: DataFrame, annots: DataFrame, window: int = 200) -> DataFrame:
    """Sites in a same-strand annotation, or on the other strand close to one of its ends: on + within `window`
    before an end, on - within `window` after one, ends themselves excluded."""
    a = annots.select("seqid", "strand", "start_pos", "end_pos")
    other = F.when(F.col("strand") == "+", "-").otherwise("+")
    near = a.select("seqid", other.alias("strand"), F.explode(F.array("start_pos", "end_pos")).alias("x"))
    plus = F.col("strand") == "+"
    near = near.select("seqid", "strand", F.when(plus, F.col("x") - window + 1).otherwise(F.col("x") + 1).alias("start_pos"), F.when(plus, F.col("x") - 1).otherwise(F.col("x") + window - 1).alias("end_pos"))
    return overlapping(sites, a.unionByName(near))


def near_match(a: DataFrame, b: DataFrame, width: int, how: str = "left_semi") -> DataFrame:
    """Sites of a with a same-strand site of b within `width`."""
    windows = b.select(F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), (F.col("position") - width).alias("start_pos"), (F.col("position") + width).alias("end_pos")).distinct()
    return point_join(a, windows, SITE_KEYS, how)


def ordered(sites: DataFrame, by: Column, ties: list, ascending: bool = True) -> DataFrame:
    """Stable order; descending is the reverse of the ascending order, ties too."""
    cols = [by, *ties]
    return sites.orderBy(*[c.asc() if ascending else c.desc() for c in cols])


def sliced(sites: DataFrame, order: list[Column], begin: int, end: int) -> DataFrame:
    """Rows begin..end-1 of an order, by one top-k operator."""
    return sites.orderBy(*order).offset(begin).limit(end - begin)


def quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """One row: the sorted value at index floor(n q), the last if that is past the end; no row for an empty table.

    Distinct values are counted before the running sum, which walks value ranges, not rows."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    upto = running(counts, column, "n")
    at = F.least(F.floor(F.col("total") * F.lit(q)), F.col("total") - 1)
    return upto.crossJoin(F.broadcast(total)).where((F.col("upto") > at) & (F.col("upto") - F.col("n") <= at)).select(F.col(column).alias("quantile"))


def quantiles(df: DataFrame, column: str, qs: dict[str, float]) -> DataFrame:
    """One row with a column for each name and q: the values at index floor(n q), all from one running count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    upto = running(counts, column, "n").crossJoin(F.broadcast(total))
    at = lambda q: F.least(F.floor(F.col("total") * F.lit(q)), F.col("total") - 1)
    return upto.agg(*[F.min(F.when(F.col("upto") > at(q), F.col(column))).alias(name) for name, q in qs.items()])


def running(counts: DataFrame, column: str, n: str, ranges: int = 1024) -> DataFrame:
    """counts with `upto`, the running sum of n in order of a numeric column, without one task for all rows.

    Values are cut into at most `ranges` + 1 equal ranges; sums of whole ranges come from a table of that size."""
    ends = counts.agg(F.min(column).alias("lo"), F.max(column).alias("hi"))
    part = F.when(F.col("hi") > F.col("lo"), F.floor((F.col(column) - F.col("lo")) / (F.col("hi") - F.col("lo")) * ranges)).otherwise(0).cast("int")
    dealt = counts.crossJoin(F.broadcast(ends)).withColumn("_part", part).drop("lo", "hi")
    sums = dealt.groupBy("_part").agg(F.sum(n).alias("_s"))
    before = sums.select("_part", F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_part").orderBy(column)
    return dealt.join(F.broadcast(before), "_part").withColumn("upto", F.col("_before") + F.sum(n).over(within)).drop("_part", "_before")


def ordinal(df: DataFrame, column: str, then: str, per: int = 100_000) -> DataFrame:
    """df with `ordinal`, its place (from 0) in order of two whole-number columns, without one task for all rows.

    Counts by the first column give the place of each of its values; a value with many rows is cut into ranges of the
    second, whose counts give the place of each range. Rows that tie in both have different places in any order.
    Nulls are left out."""
    rows = df.where(F.col(column).isNotNull() & F.col(then).isNotNull())
    values = rows.groupBy(column).agg(F.count(F.lit(1)).alias("_n"), F.min(then).alias("_lo"), F.max(then).alias("_hi"))
    parts = F.ceil(F.col("_n") / per)
    values = running(values, column, "_n").select(column, (F.col("upto") - F.col("_n")).alias("_before"), "_lo", ((F.col("_hi").cast("double") - F.col("_lo").cast("double") + 1) / parts).alias("_width"))
    dealt = rows.join(values, column).withColumn("_part", F.floor((F.col(then).cast("double") - F.col("_lo").cast("double")) / F.col("_width")))
    sizes = dealt.groupBy(column, "_part").agg(F.count(F.lit(1)).alias("_s"))
    earlier = Window.partitionBy(column).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(column, "_part", F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_inside"))
    within = Window.partitionBy(column, "_part").orderBy(then)
    placed = dealt.withColumn("_k", F.row_number().over(within)).join(sizes, [column, "_part"])
    return placed.withColumn("ordinal", F.col("_before") + F.col("_inside") + F.col("_k") - 1).select(*df.columns, "ordinal")


def placed(df: DataFrame, *by: str) -> DataFrame:
    """df with `ordinal`, its place (from 0) in order of columns that together tell rows apart, without one task for all rows.

    Rows are dealt to ranges and sorted there once, and kept; counts of the ranges tell what lies before each."""
    held = cut(df.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_id", F.monotonically_increasing_id()))
    held = held.withColumn("_part", F.shiftright("_id", 33))  # its lower bits number the rows of a task
    sizes = held.groupBy("_part").agg(F.count(F.lit(1)).alias("_s"))
    before = sizes.select("_part", F.coalesce(F.sum("_s").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return held.join(F.broadcast(before), "_part").select(*df.columns, (F.col("_before") + F.col("_id").bitwiseAND((1 << 33) - 1)).alias("ordinal"))


def cap_at_quantile(df: DataFrame, column: str, q: float) -> DataFrame:
    """Values above the quantile lowered to it; an empty table stays empty."""
    return df.crossJoin(F.broadcast(quantile(df, column, q))).withColumn(column, F.least(F.col(column), F.col("quantile"))).drop("quantile")


def normalize(sites: DataFrame, pileup: DataFrame, max_ratio: float | None = None) -> DataFrame:
    """Occupancy as transitions by reference coverage (transitions where there is none); with max_ratio only
    sites whose mutations / (coverage + 1) stay below it. pileup: seqid, position, strand, total, mutated."""
    total = F.coalesce("total", F.lit(0))
    out = sites.join(pileup, ["seqid", "position", "strand"], "left")
    if max_ratio is not None:
        out = out.where(F.coalesce("mutated", F.lit(0)) / (total + 1) < max_ratio)
    return out.withColumn("occupancy", F.when(total == 0, F.col("transitions").cast("double")).otherwise(F.col("transitions") / total)).drop("total", "mutated")


def merge_counts(universe: DataFrame, factor: DataFrame | None, mock: DataFrame) -> DataFrame:
    """The site universe with k and n of both experiments, zero where a site is not covered."""
    keys = ["chrom", "pos", "strand"]
    out = universe
    for name, df in (("factor", factor), ("mock", mock)):
        if df is not None:
            out = out.join(df.select(*keys, F.col("k").alias(f"k_{name}"), F.col("n").alias(f"n_{name}")), keys, "left")
    return out.fillna(0)


def upgrade_legacy(df: DataFrame) -> DataFrame:
    """chromosome, position, m, r, pvalue, strand, occ to the present columns, with score = 1 - p."""
    return df.select(
        F.col("chromosome").alias("seqid"), "position", F.col("m").alias("transitions"), F.col("r").alias("coverage"),
        (1 - F.col("pvalue")).alias("score"), "strand", F.col("occ").alias("occupancy"), F.col("pvalue").alias("p_value"),
    )


def jaccard(a: DataFrame, b: DataFrame, width: int, clamp: float | None = None) -> DataFrame:
    """q_a, q_b, jaccard of all pairs of occupancy bands (lower bound excluded): matched / (|a| + |b| - matched), at
    most `clamp`.

    a, b: seqid, position, strand, band."""
    size_a = a.groupBy(F.col("band").alias("q_a")).agg(F.count(F.lit(1)).alias("na"))
    size_b = b.groupBy(F.col("band").alias("q_b")).agg(F.count(F.lit(1)).alias("nb"))
    windows = b.select(F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), (F.col("position") - width).alias("start_pos"), (F.col("position") + width).alias("end_pos"), F.col("band").alias("q_b")).distinct()
    hits = point_join(a, windows, SITE_KEYS).select("site_id", F.col("band").alias("q_a"), "q_b").distinct()
    matched = hits.groupBy("q_a", "q_b").agg(F.count(F.lit(1)).alias("m"))
    grid = size_a.crossJoin(F.broadcast(size_b)).join(matched, ["q_a", "q_b"], "left").fillna(0)  # parts x parts rows
    share = F.round(F.col("m") / (F.col("na") + F.col("nb") - F.col("m")), 4)
    return grid.select("q_a", "q_b", (share if clamp is None else F.least(share, F.lit(clamp))).alias("jaccard"))


def bands(df: DataFrame, column: str, parts: int = 10) -> DataFrame:
    """Rows with `band`: the first q = 1/parts, 2/parts, ... whose exact quantile is not below the value."""
    names = [f"_q{k}" for k in range(1, parts)]
    out = df.crossJoin(F.broadcast(quantiles(df, column, {n: k / parts for k, n in enumerate(names, 1)})))
    band = F.lit(parts)
    for k in range(parts - 1, 0, -1):
        band = F.when(F.col(column) <= F.col(names[k - 1]), k).otherwise(band)
    return out.withColumn("band", band).drop(*names)


def colocalization(top: DataFrame, other: DataFrame, width: int, relative: bool = False) -> DataFrame:
    """Mean over `top` sites of the largest occupancy of `other` within `width`, sum and count both beginning at 1;
    relative: the log2 of that mean by the median occupancy of `other` (null if that is not positive)."""
    windows = top.select("site_id", F.col("seqid").alias("a_seqid"), F.col("strand").alias("a_strand"), (F.col("position") - width).alias("start_pos"), (F.col("position") + width).alias("end_pos")).withColumnRenamed("site_id", "t_id")
    best = point_join(other, windows, SITE_KEYS).groupBy("t_id").agg(F.max("occupancy").alias("best"))
    out = best.agg(((F.lit(1.0) + F.coalesce(F.sum("best"), F.lit(0.0))) / (F.count(F.lit(1)) + 1)).alias("colocalization"), F.count(F.lit(1)).alias("matched"))
    if relative:
        middle = other.agg(F.expr("percentile(occupancy, 0.5D)").alias("_m"))
        out = out.crossJoin(F.broadcast(middle)).withColumn("colocalization", F.when(F.col("_m") > 0, F.log2(F.col("colocalization") / F.col("_m")))).drop("_m")
    return out
