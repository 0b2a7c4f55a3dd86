"""Goldens of sites, sequences and file formats."""

import random

import pytest
from pyspark.sql import functions as F

from bindery.functions import sequences as seq
from bindery.operators import intervals, sites
from bindery.sources import tables

ROWS = [
    ("seqA", 14, 3, 8, 1.5, "+", 0.6), ("seqA", 15, 4, 9, 2.5, "-", 0.45), ("seqA", 21, 6, 7, 2.0, "+", 0.9),
    ("seqA", 23, 2, 6, 0.5, "-", 0.25), ("seqB", 40, 5, 31, 3.5, "+", 0.15),
]
SCHEMA = ", ".join(f"{c} {k}" for c, k in tables.SITE_COLUMNS.items())
ANNOT = "annot_id bigint, seqid string, start_pos bigint, end_pos bigint, strand string, feature string"


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def places(df):
    return [r.position for r in df.collect()]


@pytest.mark.parametrize("where, want", [(("seqA", 14, 21, "+"), [14, 21]), (("seqA", 14, 21, "-"), [15]), (("seqA", 23, 23, "-"), [23]), (("seqB", 33, 41, "+"), [40]), (("seqC", 1, 99, "+"), [])])
def test_overlaps(spark, table, where, want):
    s, a, b, strand = where
    annots = spark.createDataFrame([(1, s, a, b, strand, "gene")], ANNOT)
    assert sorted(places(sites.overlapping(table, annots))) == want
    assert sorted(places(sites.overlapping(table, annots, "left_anti"))) == [p for p in (14, 15, 21, 23, 40) if p not in want]


def test_order_and_slices(table):
    top = lambda *by: places(sites.sliced(table, list(by), 0, 3))
    assert top(F.desc("occupancy")) == [21, 14, 15]
    assert top(F.desc("score")) == [40, 15, 21]
    assert top(F.col("seqid"), F.col("position")) == [14, 15, 21]
    down = sites.ordered(table.withColumn("even", F.col("position") % 2), F.col("even"), [F.col("position")], ascending=False)
    assert places(down) == [23, 21, 15, 40, 14]


def test_features(spark, table):
    annots = spark.createDataFrame([(1, "seqA", 20, 20, "+", "snRNA"), (2, "seqB", 40, 50, "+", "tRNA"), (3, "seqB", 1, 40, "+", "gene")], ANNOT)
    assert sorted(places(sites.filter_features(table, annots, ["snRNA"], padding=1))) == [14, 15, 23, 40]
    assert sorted(places(sites.filter_features(table, annots, ["snRNA"]))) == [14, 15, 21, 23, 40]
    assert sorted(places(sites.filter_features(table, annots, []))) == [14, 15, 21, 23, 40]
    named = {r.position: r.annotation for r in sites.annotate(table, annots, ["seqid", "position", "strand"]).collect()}
    assert named == {14: "NA", 15: "NA", 21: "NA", 23: "NA", 40: "gene|tRNA"}
    assert sites.filter_features(table.limit(0), annots, ["snRNA"]).count() == 0


def test_placed_is_the_order_of_columns(spark):
    r = random.Random(5)
    rows = [(r.choice([None, -(2**60), 0, 0, 0, 7, 2**60]), r.randrange(5), i) for i in range(3_000)]
    df = spark.createDataFrame(rows, "a bigint, b bigint, c bigint").repartition(7)
    got = {x.c: x.ordinal for x in sites.placed(df, "a", "b", "c").collect()}
    order = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    assert got == {c: i for i, (_, _, c) in enumerate(order)}
    assert sites.placed(df.where("c < 0"), "a", "c").count() == 0


def test_annotate_keeps_null_and_repeated_rows(spark):
    annots = spark.createDataFrame([(1, "s", 5, 9, "+", "gene"), (2, "s", 7, 200_000, "+", "exon"), (3, "s", 7, 8, "+", "gene")], ANNOT)
    rows = [("s", 6, "+", None), ("s", 6, "+", None), ("s", 8, "+", 0.5), ("s", 8, "+", 0.5), ("s", 8, "+", None), ("s", 8, "-", 0.9), (None, 8, "+", 0.1), ("s", None, "+", 0.2), ("s", 150_000, "+", 0.3)]
    df = spark.createDataFrame(rows, "seqid string, position bigint, strand string, occupancy double")
    got = sorted(map(tuple, sites.annotate(df, annots, df.columns).collect()), key=repr)
    name = lambda r: "NA" if None in r[:3] or r[2] == "-" else {6: "gene", 8: "exon|gene", 150_000: "exon"}[r[1]]
    assert got == sorted(((*r, name(r)) for r in rows), key=repr)
    assert sorted(r.occupancy for r in sites.annotate(df, annots, df.columns, max_n=3).collect()) == [0.5, 0.5, 0.9]
    assert sites.annotate(df.limit(0), annots, df.columns).count() == 0


def test_ordinals(spark):
    rows = [(k * 7919 % 13, k) for k in range(500)] + [(3, 77), (None, 1), (2, None)]
    got = sites.ordinal(spark.createDataFrame(rows, "a bigint, b bigint"), "a", "b", per=10).orderBy("ordinal").collect()
    assert [r.ordinal for r in got] == list(range(501))
    assert [(r.a, r.b) for r in got] == sorted(r for r in rows if None not in r)


def test_distances(spark):
    rows = [(1, "s", 10, 20, "+", "g"), (2, "s", 15, 40, "-", "g"), (3, "s", 26, 30, "+", "g"), (4, "s", 44, 50, "-", "g"), (5, "s", 52, 60, "-", "g"), (6, "t", 1, 2, "+", "g")]
    a = spark.createDataFrame(rows, ANNOT)
    d = lambda df: {r.annot_id: r.distance for r in df.collect()}
    assert d(sites.next_distance(a, -99)) == {1: 6, 2: None, 3: None, 4: 4, 5: 2, 6: None}
    assert d(sites.next_distance(a, -99, opposite=True)) == {1: -5, 2: -5, 3: 14, 4: 14, 5: 22, 6: None}
    # By hand: 4 goes (4 < 5), so 5 looks back at 2.
    assert sorted(r.annot_id for r in sites.next_distance_exact(a, 5).collect()) == [1, 2, 3, 5, 6]
    more = intervals.insert(a, spark.createDataFrame([(7, "t", 5, 6, "-", "g")], ANNOT))
    assert more.count() == 7 and sorted(r.annot_id for r in intervals.remove(more, spark.createDataFrame([(7,), (1,)], "annot_id bigint"), "annot_id").collect()) == [2, 3, 4, 5, 6]


def loop_exact(rows, minimum):
    """The filter row by row: + rows look ahead, others back at what is left."""
    kept = set()
    groups = {(r[1], r[4]) for r in rows}
    for seqid, strand in groups:
        mine = sorted((r for r in rows if (r[1], r[4]) == (seqid, strand)), key=lambda r: (r[2], r[3], r[0]))
        last = None
        for k, r in enumerate(mine):
            if strand == "+":
                d = mine[k + 1][2] - r[3] if k + 1 < len(mine) else 0
            else:
                d = r[2] - last if last is not None else 0
            if d == 0 or d >= minimum:
                kept.add(r[0])
                last = r[3]
    return kept


@pytest.mark.parametrize("ranges", [1, 7, 64])
def test_distances_in_ranges(spark, ranges):
    r = random.Random(ranges)
    rows = []
    for i in range(600):
        start = r.randint(1, 4000)
        rows.append((i, r.choice("st"), start, start + r.choice([0, 3, 9, 40, 400]), r.choice("+--"), "g"))
    rows += [(1000 + k, "u", 10 * k, 10 * k + 4, "-", "g") for k in range(300)]
    a = spark.createDataFrame(rows, ANNOT)
    for minimum in (-5, 0, 1, 6, 50):
        assert {x.annot_id for x in sites.next_distance_exact(a, minimum, ranges=ranges).collect()} == loop_exact(rows, minimum), minimum
    order = lambda x: (x[2], x[3], x[0])
    for opposite in (False, True):
        got = {x.annot_id: x.distance for x in sites.next_distance(a, -1 << 40, opposite=opposite, ranges=ranges).collect()}
        for x in rows:
            asked = [y for y in rows if y[1] == x[1] and (y[4] == x[4]) != opposite]
            later, earlier = [y for y in asked if order(y) > order(x)], [y for y in asked if order(y) < order(x)]
            want = (min(later, key=order)[2] - x[3] if later else None) if x[4] == "+" else (x[2] - max(earlier, key=order)[3] if earlier else None)
            assert got[x[0]] == want, x
    assert sites.next_distance(a.limit(0), 1).count() == 0 and sites.next_distance_exact(a.limit(0), 1).count() == 0


def test_many_annotations_of_one_chromosome(spark):
    a = spark.range(300_000).selectExpr("id as annot_id", "'c' as seqid", "id * 5 as start_pos", "id * 5 + id % 9 as end_pos", "if(id % 3 = 0, '+', '-') as strand", "'g' as feature")
    assert sites.next_distance(a, 1, opposite=True).count() > 0
    assert sites.next_distance_exact(a, 3).count() > 0


def test_long_intervals_meet_points_once(spark):
    points = spark.createDataFrame([("c", p) for p in range(1, 400_000, 997)], "seqid string, position bigint")
    spans = [(k, "c", s, e) for k, (s, e) in enumerate([(1, 399_999), (10, 10), (1, 1), (64_000, 64_999), (100, 64_101), (5, 64_006), (300_000, 700_000)])]
    annots = spark.createDataFrame(spans, "annot_id bigint, a_seqid string, start_pos bigint, end_pos bigint")
    got = sorted((r.position, r.annot_id) for r in intervals.point_join(points, annots, (("seqid", "a_seqid"),)).collect())
    assert got == sorted((p, k) for p in range(1, 400_000, 997) for k, _, s, e in spans if s <= p <= e)


def test_intervals_are_validated(spark):
    df = spark.createDataFrame([(0, 5)], "start_pos bigint, end_pos bigint")
    assert intervals.closed(df, True).first().start_pos == 1
    with pytest.raises(Exception, match="ends before"):
        intervals.closed(spark.createDataFrame([(7, 5)], "start_pos bigint, end_pos bigint"), False).collect()


def test_sequences(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("c")).first().c
    assert get(seq.revcomp(F.lit("GATTACACN-"))) == "-NGTGTAATC" and get(seq.revcomp(F.lit("AXC"))) is None
    assert get(seq.occurrences(F.lit("ACACACGACA"), "ACA")) == [0, 2, 7] and get(seq.occurrences(F.lit("A"), "ACA")) == []
    bases = F.lit("..G,,Ag.T,c")
    forward, reverse = seq.base_counts(bases, True), seq.base_counts(bases, False)
    assert [get(forward[k]) for k in ("coverage", "G", "mutations")] == [6, 1, 3]
    assert [get(reverse[k]) for k in ("coverage", "G", "mutations")] == [5, 1, 2]
    assert get(seq.strip_markup(F.lit("^I.+2ACt$,-1G*c"))) == ".t,c"
    assert [(r.ref, r.pos) for r in get(seq.md_mismatches(F.lit("3A2^CC1T")))] == [("A", 3), ("T", 7)]


def test_site_files(spark, table, tmp_path):
    path = f"{tmp_path}/sites"
    tables.write_sites(table.withColumn("note", F.when(F.col("position") > 15, "x")), path, [F.desc("occupancy")])
    back = tables.read_sites(spark, path)
    assert [tuple(r)[:7] for r in back.orderBy("position").collect()] == ROWS and back.where("note is null").count() == 2
    (tmp_path / "bad").write_text("seqid\tposition\nchrI\t1\n")
    with pytest.raises(ValueError):
        tables.read_sites(spark, f"{tmp_path}/bad")
    (tmp_path / "wide").write_text("\t".join(tables.SITE_COLUMNS) + "\nchrI\t1\t2\t3\t.\t+\t0.5\nchrI\t1\n")
    assert [tuple(r) for r in tables.read_sites(spark, f"{tmp_path}/wide").collect()] == [("chrI", 1, 2, 3, None, "+", 0.5)]


def test_other_formats(spark, tmp_path):
    (tmp_path / "a.gff").write_text("##gff\nchrI\tsrc\tgene\t1\t9\t.\t+\t.\tID=g1;Note=a%20b\nchrI\tsrc\tgene\t2\t3\t1.5\t-\t0\tfree text\nshort\n")
    got = tables.read_gff(spark, f"{tmp_path}/a.gff").orderBy("start_pos").collect()
    assert [(r.start_pos, r.score, r.attributes) for r in got] == [(1, None, {"ID": "g1", "Note": "a b"}), (2, 1.5, {"annot": "free text"})]
    (tmp_path / "g.fa").write_text(">chr1 first\nACGT\nacg\n>chr2\nTT\n")
    assert {r.seqid: r.seq for r in tables.read_fasta(spark, f"{tmp_path}/g.fa").collect()} == {"chr1": "ACGTACG", "chr2": "TT"}
    assert sorted((r.seqid, r.chunk_start, r.seq) for r in tables.read_fasta_chunks(spark, f"{tmp_path}/g.fa", 4).collect()) == [("chr1", 1, "ACGT"), ("chr1", 5, "ACG"), ("chr2", 1, "TT")]
    (tmp_path / "r.fq").write_text("@r1\nACGT\n+\n@III\n@r2\nGG\n+x\nII\n")
    assert [tuple(r) for r in tables.read_fastq(spark, f"{tmp_path}/r.fq").collect()] == [("r1", "ACGT", "+", "@III"), ("r2", "GG", "+x", "II")]
    (tmp_path / "p").write_text('chrI\t5\tT\t3\t.C"\tII"\nbad row\n')
    assert [tuple(r) for r in tables.read_pileup(spark, f"{tmp_path}/p").collect()] == [("chrI", 5, "T", 3, '.C"', 'II"')]
    (tmp_path / "fai").write_text("chr1\t7\t12\t4\n")
    assert tables.check_index(tables.read_fasta_chunks(spark, f"{tmp_path}/g.fa", 4), spark.createDataFrame([("chr1", 7), ("chr2", 3)], "seqid string, length bigint")).first().seqid == "chr2"
    with pytest.raises(Exception, match="corrupt"):
        tables.read_fai(spark, f"{tmp_path}/fai").collect()
