"""Formats read in splits, writers, and long sequences."""

import math
import random
from collections import Counter
from itertools import product

import pytest
from pyspark.sql import functions as F

from bindery.functions import sequences as seq
from bindery.operators import kmers, pileup
from bindery.sources import tables


@pytest.fixture
def small_splits(spark):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "600")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def test_fastq_in_splits(small_splits, tmp_path):
    r = random.Random(4)
    for name in "ab":
        rows = []
        for k in range(120):
            n = r.randint(0, 60)
            rows.append((f"{name}{k} x", "".join(r.choice("ACGTN") for _ in range(n)), "+", "".join(r.choice("@+I#A") for _ in range(n))))
        (tmp_path / f"{name}.fq").write_text("".join(f"@{i}\n{s}\n{p}\n{q}\n" for i, s, p, q in rows))
        assert sorted(map(tuple, tables.read_fastq(small_splits, f"{tmp_path}/{name}.fq").collect())) == sorted(rows)
    assert tables.read_fastq(small_splits, str(tmp_path)).count() == 240 and tables._split_lines(small_splits, str(tmp_path)).rdd.getNumPartitions() > 8
    (tmp_path / "crlf").write_bytes(b"@r\r\nAC\r\n+\r\nII\r\n")
    assert [tuple(x) for x in tables.read_fastq(small_splits, f"{tmp_path}/crlf").collect()] == [("r", "AC", "+", "II")]


def test_fasta_in_splits(small_splits, tmp_path):
    r = random.Random(5)
    genome = {f"chr{k}": "".join(r.choice("ACGTacgtN") for _ in range(n)) for k, n in enumerate((0, 1, 2500, 60, 7, 901))}
    for name, ids in (("a", ("chr0", "chr2", "chr3")), ("b", ("chr1", "chr4", "chr5"))):
        (tmp_path / f"{name}.fa").write_text("".join(f">{i} note\n" + "".join(genome[i][k : k + 61] + "\n" for k in range(0, len(genome[i]), 61)) for i in ids))
    chunks = tables.read_fasta_chunks(small_splits, str(tmp_path), 100)
    got = {}
    for x in chunks.orderBy("seqid", "chunk_start").collect():
        assert x.chunk_start == len(got.get(x.seqid, "")) + 1 and len(x.seq) <= 100
        got[x.seqid] = got.get(x.seqid, "") + x.seq
    assert got == {k: v.upper() for k, v in genome.items() if v}
    regions = [(f"chr{r.randrange(6)}", a, a + r.randint(-1, 250), r.choice("+-")) for a in (r.randint(-2, 2500) for _ in range(300))]
    df = small_splits.createDataFrame(regions * 2, "seqid string, start_pos bigint, end_pos bigint, strand string")
    flip = str.maketrans("ACGT", "TGCA")
    want = [(s, a, b, d, (lambda t: t[::-1].translate(flip) if d == "-" else t)(genome[s].upper()[a - 1 : b])) for s, a, b, d in regions * 2 if 1 <= a <= b <= len(genome[s])]
    assert sorted(map(tuple, tables.fetch(chunks, df, 100).collect())) == sorted(want) and len(want) > 50
    index = small_splits.createDataFrame([(k, len(v)) for k, v in genome.items() if v], "seqid string, length bigint")
    assert tables.check_index(chunks, index).count() == 0


def test_long_sequence(spark):
    """Five million letters in one row."""
    r = random.Random(6)
    unit = "".join(r.choice("ACGT") for _ in range(50_000))
    df = spark.createDataFrame([("s", unit * 100)], "seqid string, seq string")
    got = {x.kmer: x.n for x in kmers.count(df, 3).collect()}
    whole = unit * 100
    assert sum(got.values()) == len(whole) - 2 and got["ACG"] == sum(whole.startswith("ACG", i) for i in range(50_000)) * 100 - (0 if (unit + unit)[49_998:50_001] != "ACG" and (unit + unit)[49_999:50_002] != "ACG" else 0) - int(whole[-2:] + unit[:1] == "ACG") - int(whole[-1:] + unit[:2] == "ACG")
    assert pileup.site_universe(df).count() == whole.count("T") + whole.count("A")
    at = spark.createDataFrame([("s", 4_999_990, "+"), ("s", 10_003, "-"), ("s", 5, "+"), ("s", 4_999_996, "+")], "seqid string, position bigint, strand string")
    seen = {x.position: x.seq for x in kmers.windows(at, df, 5).collect()}
    assert seen == {4_999_990: whole[4_999_984:4_999_995], 10_003: whole[9_997:10_008][::-1].translate(str.maketrans("ACGT", "TGCA"))}
    kept = {x.position: x.seq for x in kmers.windows(at, df, 5, keep=True).collect()}
    assert kept[5] is None and kept[4_999_996] is None and len(kept) == 4


def test_chunks(spark):
    one = lambda c: spark.range(1).select(c.alias("c")).first().c
    assert one(seq.chunks(F.lit("abcdefg"), 3, 2)) == ["abcde", "defg", "g"] and one(seq.chunks(F.lit(""), 3, 2)) == []
    assert one(seq.kmers(F.lit("ab\ncd"), 2)) == ["ab", "b\n", "\nc", "cd"] and one(seq.kmers(F.lit("a"), 2)) == []


def test_adapter_modes(spark):
    df = spark.createDataFrame([("GATCAAC",), ("ATCAAC",), ("AACATCGG",), ("TT",)], "s string")
    left = lambda mode: [r.c for r in df.select(seq.remove_five(F.col("s"), "GATC", 3, mode).alias("c")).collect()]
    assert left("strict") == ["AAC", "ATCAAC", "AACATCGG", "TT"]
    assert left("seeded") == ["AAC", "AAC", "AACATCGG", "TT"]
    assert left("anywhere") == ["AAC", "AAC", "GG", "TT"]


def test_other_readers_and_writers(spark, tmp_path):
    (tmp_path / "old").write_text("chromosome\tposition\tm\tr\tpvalue\tstrand\tocc\nc\t5\t2\t9\t0.25\t+\t.\nc\t5\n")
    assert [tuple(r) for r in tables.read_legacy(spark, f"{tmp_path}/old").collect()] == [("c", 5, 2, 9, 0.25, "+", None)]
    (tmp_path / "x.sam").write_text("@HD\tx\nr1\t16\tc\t7\t30\t3M\t*\t0\t0\tACG\tII#\tNM:i:1\tMD:Z:1T1\nr2\t4\t*\t0\t0\t*\t*\t0\t0\tA\tI\n")
    a, b = tables.read_sam(spark, f"{tmp_path}/x.sam").orderBy("read_id").collect()
    assert (a.chrom, a.start, a.cigar, a.quals, a.mapped, a.fwd, a.nm, a.md) == ("c", 7, "3M", [40, 40, 2], True, False, 1, "1T1") and not b.mapped and b.nm == 0
    info = spark.range(1).select(tables.info_part(F.lit("ID=7;Name=abc;x"), "Name=", ";").alias("i")).first().i
    assert info == "abc"
    (tmp_path / "1.gff").write_text("c\ts\tgene\t1\t9\t.\t+\t.\tID=g 1;Note=a%3Bb\n")
    (tmp_path / "2.gff").write_text("c\ts\texon\t2\t3\t.\t-\t.\tID=e\n")
    both = tables.read_gff(spark, [f"{tmp_path}/1.gff", f"{tmp_path}/2.gff"])
    assert both.count() == 2
    tables.write_gff(both, f"{tmp_path}/out")
    assert sorted(map(str, tables.read_gff(spark, f"{tmp_path}/out").collect())) == sorted(map(str, both.collect()))
    w = spark.createDataFrame([(0, "c", 9, "+", 0.25, 3, "ACG"), (1, "c", 2, "-", 0.0, 1, None), (2, "c", 4, "-", 0.0, 1, "TTT")], "ordinal int, seqid string, position bigint, strand string, occupancy double, transitions int, seq string")
    assert [r.value for r in tables.fasta_lines(w).orderBy("rank").collect()] == [">seq:0:c:9:+:0.25:3:12.0\nACG", ">seq:2:c:4:-:0.0:1:\nTTT"]
    tables.write_fasta(w, f"{tmp_path}/fa")
    assert {r.seqid for r in tables.read_fasta(spark, f"{tmp_path}/fa").collect()} == {"seq:0:c:9:+:0.25:3:12.0", "seq:2:c:4:-:0.0:1:"}
    assert tables.duplicate_lines(spark.createDataFrame([(2, 7)], "multiplicity bigint, sequences bigint")).first().value == "%15d  %15d" % (2, 7)


def most_rows(df):
    """Rows of df, and the most that a step of its plan made."""
    rows, most = df.collect(), 0
    todo = [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        if node.metrics().contains("numOutputRows"):
            most = max(most, node.metrics().get("numOutputRows").get().value())
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows, most


@pytest.mark.parametrize("k", [1, 3, 9])
def test_kmers_are_counted_without_a_row_for_each_letter(spark, k):
    r = random.Random(k)
    texts = ["".join(r.choices("ACGTNa\u00e4\n", [9, 9, 9, 9, 1, 1, 1, 1], k=r.choice([0, 1, 2, 3, 40, 9_000]))) for _ in range(400)]
    texts += [None, "", "AC\n", "ACG\n", "GATTACA" * 5_000]
    rows = [(i % 3, s) for i, s in enumerate(texts)]
    want = Counter((b, s[i : i + k]) for b, s in rows if s for i in range(len(s) - k + 1) if set(s[i : i + k]) <= set("ACGT"))
    seqs = spark.createDataFrame(rows, "bin int, seq string").repartition(2)
    found, most = most_rows(kmers.count(seqs, k))
    whole = Counter()
    for (_, x), n in want.items():
        whole[x] += n
    assert {x.kmer: x.n for x in found} == whole and sum(whole.values()) > 100_000
    if k < 9:
        assert most < 10_000
        background = spark.createDataFrame([("".join(x), 0.25**k) for x in product("ACGT", repeat=k)], "kmer string, freq double")
        odds, most = most_rows(kmers.log_odds(seqs, background, k))
        total = {b: sum(want[b, "".join(x)] + 1 for x in product("ACGT", repeat=k)) for b in range(3)}
        assert len(odds) == 3 * 4**k and most < 10_000
        assert all(abs(x.log_odds - math.log2((want[x.bin, x.kmer] + 1) / total[x.bin] / 0.25**k)) < 1e-9 for x in odds)


@pytest.mark.parametrize("k", [1, 3])
def test_spectra_count_each_text_by_itself(spark, k):
    r = random.Random(k)
    texts = ["".join(r.choices("ACGTacgtnN \u00e4\n\ufb05\u1e97", k=r.choice([0, 1, 2, 3, 40, 900]))) for _ in range(700)]
    texts += [None, "", "n", "a c\ng", "gattaca" * 100_000, "A" * kmers.LETTERS, "C" * (kmers.LETTERS - 1), None, "CGT"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string").repartition(2)
    got = {x.id: x for x in kmers.spectra(df, k).collect()}
    names = sorted("".join(x) for x in product("ACGT", repeat=k))
    assert len(got) == len(texts)
    total = Counter()
    for i, text in enumerate(texts):
        letters = "".join(c.upper() for c in text or "" if c in "ACGTacgt")
        want = Counter(letters[j : j + k] for j in range(len(letters) - k + 1))
        total.update(want)
        assert got[i].letters == (None if text is None else len(letters)) and got[i].counts == [want[x] for x in names]
    assert {x.kmer: x.n for x in kmers.summed(kmers.spectra(df, k), k).collect()} == total
    assert [x.kmer for x in kmers.universe(spark, k).orderBy("kmer").collect()] == names
    none = kmers.summed(kmers.spectra(df.where("id < 0"), k), k).collect()
    assert len(none) == 4**k and not any(x.n for x in none)


@pytest.mark.parametrize("text", [None, "", "abc", "abcd", "abcde", "\U0001f9ec" * 4, "\U0001f9ec" * 9])
def test_short_texts_are_one_piece(spark, text):
    got = spark.createDataFrame([(text,)], "s string").select(seq.chunks(F.col("s"), 4, 1).alias("c")).first().c
    assert got == (None if text is None else [text[i : i + 5] for i in range(0, len(text), 4)])


def test_kmer_extras(spark):
    pwm = spark.createDataFrame([(0, "A", 0.75), (0, "C", 0.25), (1, "G", 1.0)], "pos int, base string, p double")
    assert sorted(map(tuple, kmers.reverse_pwm(pwm, 2).collect())) == [(0, "C", 1.0), (1, "G", 0.25), (1, "T", 0.75)]
    seqs = spark.createDataFrame([("ACGT",), ("ACTT",)], "seq string")
    dense = kmers.by_position(seqs, 2, dense=True, width=3)
    assert dense.count() == 48 and dense.agg(F.sum("n")).first()[0] == 6
    assert kmers.quartiles(dense).where("pos = 0").first().q75 == 0
    odds = kmers.log_odds(seqs.withColumn("bin", F.lit(0)), kmers.frequencies(kmers.count(seqs, 2, 1)), 2, clamp=0.01)
    assert odds.where("abs(log_odds) > 0.01").count() == 0


def test_plain_tables(spark, tmp_path):
    df = spark.createDataFrame([("AC", 3, [1.5, 2.0]), ("AA", None, [0.0, 7.25]), ("T\"T", 1, [])], "kmer string, n int, v array<double>")
    tables.write_plain(df, str(tmp_path / "p"), [F.col("kmer")])
    lines = [x for f in sorted((tmp_path / "p").glob("part-*.txt")) for x in f.read_text().splitlines()]
    assert lines == ["AA\t\t0.0\t7.25", "AC\t3\t1.5\t2.0", 'T"T\t1\t']
