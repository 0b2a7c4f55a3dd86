"""Unique molecular identifiers: taken from reads, and reads of one molecule told by networks of similar ones.

Reads that begin at one place of one strand are copies if their identifiers are equal, or if one came from the other by
an error: they differ in one letter, and the parent has at least 2 n - 1 reads where the child has n. Each identifier belongs
to the most frequent one (ties: the first by letters) from which steps from parent to child lead to it.

Identifiers at distance one agree when one letter is masked in both, so each lists its masked forms, and under a form
meet at most as many as there are letters; no pairs of a place are compared. Leads then pass down these edges.
Between identifiers of several reads counts grow by each step up, so that takes few rounds; those of a single read
may form long chains and rings, whose edges go both ways, so they are joined to components by star contractions first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.operators.alignments import reference_length
from bindery.operators.lineage import cut


def extract(reads: DataFrame, length: int) -> DataFrame:
    """Reads with their first `length` letters moved to `umi` and to the end of the first word of their id; shorter reads are left out.

    Columns id, seq, qual; others stay."""
    umi = F.substring("seq", 1, length)
    name = F.regexp_replace("id", r"^(\S*)", F.concat(F.lit("$1_"), umi))
    rest = lambda c: F.substring(F.col(c), F.lit(length + 1), F.length(c))
    taken = reads.where(F.length("seq") >= length).withColumns({"umi": umi, "id": name})
    return taken.withColumns({"seq": rest("seq"), "qual": rest("qual")})


def of_name(read_id: Column) -> Column:
    """The identifier at the end of the first word of a read's id."""
    return F.regexp_extract(read_id, r"^\S*_([A-Za-z]+)", 1)


def begins(align: DataFrame) -> Column:
    """Where a read's first letter lies on the reference, soft-clipped letters counted: its 5' end on its strand."""
    clip = lambda p: F.coalesce(F.regexp_extract("cigar", p, 1).try_cast("int"), F.lit(0))
    return F.when(F.col("fwd"), F.col("start") - clip(r"^(?:\d+H)?(\d+)S")).otherwise(F.col("start") + reference_length(F.col("cigar")) - 1 + clip(r"[A-Z](\d+)S(?:\d+H)?$"))


def edges(nodes: DataFrame) -> DataFrame:
    """place, parent, n_parent, child, n_child from place, umi, n."""
    forms = F.transform(F.sequence(F.lit(1), F.length("umi")), lambda i: F.concat(F.substring(F.col("umi"), F.lit(1), i - 1), F.lit("."), F.substring(F.col("umi"), i + 1, F.length("umi"))))
    met = nodes.where(F.length("umi") > 0).select("place", F.explode(forms).alias("form"), F.struct("umi", "n").alias("node")).groupBy("place", "form").agg(F.collect_list("node").alias("some")).where(F.size("some") > 1)
    pairs = met.select("place", "some", F.explode("some").alias("p")).select("place", "p", F.explode("some").alias("c"))
    return pairs.where("p.umi <> c.umi and p.n >= 2 * c.n - 1").select("place", F.col("p.umi").alias("parent"), F.col("p.n").alias("n_parent"), F.col("c.umi").alias("child"), F.col("c.n").alias("n_child"))


def components(links: DataFrame) -> DataFrame:
    """node, root: each node of the undirected links (a, b) with the smallest node of its component, by alternating star contractions."""
    oriented = lambda df: df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state = lambda df: tuple(df.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    now = cut(oriented(links))
    seen = state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = oriented(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.explode(F.array(F.struct(F.col("b").alias("a"), F.col("m").alias("b")), F.struct("a", F.col("m").alias("b")))).alias("e")).select("e.*")
        now = cut(oriented(small))
        after = state(now)
        if after == seen:
            break
        seen = after
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def networks(nodes: DataFrame) -> DataFrame:
    """place, umi, n, lead: the identifier that each belongs to. nodes: place, umi, n, each place and umi once."""
    nodes = cut(nodes.select("place", "umi", "n"))
    links = cut(edges(nodes))
    own = F.struct((-F.col("n")).alias("k"), F.col("umi").alias("lead"))
    best = nodes.where("n > 1").withColumn("best", own)
    down = links.where("n_child > 1").select("place", F.col("parent").alias("umi"), "child")
    moved = down.limit(1).count()
    while moved:
        told = down.join(best, ["place", "umi"]).groupBy("place", F.col("child").alias("umi")).agg(F.min("best").alias("told"))
        after = cut(best.join(told, ["place", "umi"], "left").select("place", "umi", "n", F.least("best", "told").alias("best"), (F.col("told") < F.col("best")).alias("moved")))
        moved = after.where("moved").limit(1).count()
        best = after.drop("moved")
    name = lambda c: F.struct("place", F.col(c).alias("umi"))
    single = components(links.where("n_child = 1 and n_parent = 1 and parent < child").select(name("parent").alias("a"), name("child").alias("b")))
    alone = nodes.where("n = 1").join(single.select("node.*", "root"), ["place", "umi"], "left").withColumn("root", F.coalesce("root", name("umi")))
    told = links.where("n_child = 1 and n_parent > 1").select("place", F.col("parent").alias("umi"), "child").join(best, ["place", "umi"]).groupBy("place", F.col("child").alias("umi")).agg(F.min("best").alias("told"))
    ends = alone.join(told, ["place", "umi"], "left").withColumn("best", F.coalesce("told", own))
    by_root = ends.groupBy("root").agg(F.min("best").alias("best"))
    low = alone.join(by_root, "root").select("place", "umi", "n", "best")
    return best.unionByName(low).select("place", "umi", "n", F.col("best.lead").alias("lead"))


def deduplicate(align: DataFrame, umi: Column | None = None) -> DataFrame:
    """One read of each molecule: of the reads of the lead identifier, that of the best mapping quality, then the smallest id; with
    `umi`, `molecule_reads` and `molecule_umis`.

    Unmapped reads and null starts are left out; a null identifier counts as the empty one, which is similar to none. Repeated
    rows count as reads. Counts are added up before they are shuffled, so a place or identifier with most of the reads does no harm."""
    columns = align.columns
    known = align.where("mapped") if "mapped" in columns else align
    quality = F.coalesce(F.col("mapq"), F.lit(0)) if "mapq" in columns else F.lit(0)
    place = F.concat_ws(":", "chrom", F.when(F.col("fwd"), "+").otherwise("-"), begins(align).cast("string"))
    each = known.where("start is not null and chrom is not null").select(place.alias("place"), F.coalesce(of_name(F.col("read_id")) if umi is None else umi, F.lit("")).alias("umi"), F.struct((-quality).alias("q"), "read_id", F.struct(*columns).alias("row")).alias("r"))
    nodes = cut(each.groupBy("place", "umi").agg(F.count(F.lit(1)).alias("n"), F.min("r").alias("r")))
    led = networks(nodes).groupBy("place", F.col("lead").alias("umi")).agg(F.sum("n").alias("molecule_reads"), F.count(F.lit(1)).alias("molecule_umis"))
    return nodes.join(led, ["place", "umi"]).select("r.row.*", F.col("umi").alias("_umi"), "molecule_reads", "molecule_umis").drop("umi").withColumnRenamed("_umi", "umi")
