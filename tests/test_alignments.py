"""Alignments, pileups, identifiers and read ends against plain loops."""

import random
import re
from collections import Counter, defaultdict

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from bindery.operators import alignments, trimming, umis
from bindery.operators.trimming import find_adapter

ALIGN = "read_id string, chrom string, start bigint, cigar string, seq string, quals array<int>, fwd boolean, mapq int, mapped boolean"


def random_reads(r, n, genome):
    out = []
    for i in range(n):
        chrom = r.choice([*genome, "missing"])
        ops = [(r.randint(1, 6), "M")]
        for _ in range(r.randint(0, 3)):
            ops += [(r.randint(1, 4), r.choice("IDNPM=X")), (r.randint(1, 5), r.choice("M=X"))]
        if r.random() < 0.2:
            ops.insert(0, (2, "I"))
        if r.random() < 0.2:
            ops.append((2, r.choice("ID")))
        if r.random() < 0.4:
            ops.insert(0, (r.randint(1, 3), "S"))
        if r.random() < 0.4:
            ops.append((r.randint(1, 3), "S"))
        if r.random() < 0.2:
            ops = [(3, "H"), *ops, (2, "H")]
        size = sum(n for n, o in ops if o in "MIS=X")
        seq = "".join(r.choice("ACGTN") for _ in range(size))
        out.append((f"r{i:04}", chrom, r.randint(1, 60), "".join(f"{n}{o}" for n, o in ops), seq, [r.randint(0, 60) for _ in range(size)], r.random() < 0.5, r.choice([0, 30, 60, 255]), r.random() < 0.9))
    return out


def brute_pileup(rows, genome):
    """Symbols of each position, one read at a time."""
    cells = defaultdict(list)
    for name, chrom, start, cigar, seq, quals, fwd, mapq, mapped in sorted(rows, key=lambda x: (x[2], x[0])):
        if not mapped:
            continue
        ref, q = start - 1, 0
        mine = []  # (position, text, quality)
        letter = lambda c: c.upper() if fwd else c.lower()  # noqa: E731, B023
        base_at = lambda p: genome.get(chrom, "")[p : p + 1] or "N"  # noqa: E731, B023
        for n, op in ((int(a), b) for a, b in re.findall(r"(\d+)([MIDNSHP=X])", cigar)):
            if op in "M=X":
                for _ in range(n):
                    same = seq[q].upper() == base_at(ref).upper()
                    mine.append([ref, (".," [not fwd]) if same else letter(seq[q]), quals[q]])
                    ref, q = ref + 1, q + 1
            elif op in "DN":
                if mine and op == "D":
                    mine[-1][1] += f"-{n}" + letter("".join(base_at(ref + k) for k in range(n)))
                for _ in range(n):
                    mine.append([ref, "*" if op == "D" else "><"[not fwd], quals[min(q, len(quals) - 1)]])
                    ref += 1
            elif op == "I":
                if mine:
                    mine[-1][1] += f"+{n}" + letter(seq[q : q + n])
                q += n
            elif op == "S":
                q += n
        mine[0][1] = "^" + chr(min(mapq, 93) + 33) + mine[0][1]
        mine[-1][1] += "$"
        for p, text, quality in mine:
            cells[chrom, p].append((text, chr(min(quality, 93) + 33)))
    return {(c, p + 1): (genome.get(c, "")[p : p + 1] or "N", len(x), "".join(t for t, _ in x), "".join(q for _, q in x)) for (c, p), x in cells.items()}


GENOME = {"c1": "ACGTTGCAacgtTTGACCAGTACGATTACCAGGGTACATTTACGACGTAGCATCGAT", "c2": "TTTACGATTGNNACGT", "c3": ""}


@pytest.mark.parametrize("piece", [7, 10_000])
def test_pileup(spark, monkeypatch, piece):
    monkeypatch.setattr(alignments, "PIECE", piece)
    rows = random_reads(random.Random(piece), 150, GENOME)
    rows += [("none", "c1", 3, "*", "ACG", [1, 2, 3], True, 1, True), ("soft", "c1", 3, "3S", "ACG", [1, 2, 3], True, 1, True)]
    genome = spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    align = spark.createDataFrame(rows, ALIGN)
    got = {(x.chrom, x.pos): (x.ref, x.depth, x.bases, x.quals) for x in alignments.pileup(align, genome).collect()}
    want = brute_pileup(rows[:-2], GENOME)
    assert got == want
    n = Counter()
    for (c, p), (ref, _, bases, _) in want.items():
        for x in re.sub(r"\^.|\$", "", re.sub(r"[+-](\d+)", lambda m: "\0" + m[1] + "\0", bases)).split("\0")[:1]:
            n.update((c, p, ref, "+" if b in ".ACGTN" else "-", ref.upper() if b in ".," else b.upper()) for b in x if b in ".,ACGTNacgtn")
    counts = {(x.chrom, x.pos, x.ref, x.strand, x.base): x.n for x in alignments.position_counts(align, genome).collect() if x.base != "-"}
    assert all(counts[k] >= v for k, v in n.items()) and sum(counts.values()) == sum(len(re.findall("", "x" * sum(int(a) for a, b in re.findall(r"(\d+)([M=X])", r[3])))) - 1 for r in rows[:-2] if r[8])


def test_a_deep_position_is_put_together_in_parts(spark, monkeypatch):
    monkeypatch.setattr(alignments, "DEEP", 50)
    rows = [(f"r{i:04}", "c1", 5, "4M", "ACGT"[i % 4] * 4, [i % 40] * 4, i % 2 == 0, 60, True) for i in range(400)]
    genome = spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    got = {x.pos: x for x in alignments.pileup(spark.createDataFrame(rows, ALIGN), genome).collect()}
    want = brute_pileup(rows, GENOME)
    assert sorted(got) == [5, 6, 7, 8]
    for p, x in got.items():
        ref, depth, bases, quals = want["c1", p]
        assert (x.ref, x.depth, Counter(x.bases), Counter(x.quals)) == (ref, depth, Counter(bases), Counter(quals))
    assert alignments.pileup(spark.createDataFrame([], ALIGN), genome).count() == 0


def shuffled_rows(df):
    """Rows of df, and how many rows its shuffles wrote."""
    rows, n = df.collect(), 0
    todo = [df._jdf.queryExecution().executedPlan().executedPlan()]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName().endswith("QueryStageExec"):
            node = node.plan()
        if node.metrics().contains("shuffleRecordsWritten"):
            n += node.metrics().get("shuffleRecordsWritten").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows, n


def test_whole_reads_are_shuffled_and_not_their_bases(spark):
    rows = [(f"r{i:04}", "c1", 1 + i % 7, "20M2D20M", "ACGTTGCAGT" * 4, [i % 40] * 40, i % 2 == 0, 60, True) for i in range(300)]
    align, genome = spark.createDataFrame(rows, ALIGN), spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    found, n = shuffled_rows(alignments.pileup(align, genome))
    assert {(x.chrom, x.pos): (x.ref, x.depth, x.bases, x.quals) for x in found} == brute_pileup(rows, GENOME)
    assert 0 < n <= len(rows) + len(GENOME)


def test_counts_by_base_shuffle_whole_reads(spark, monkeypatch):
    genome = spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    rows = [(f"r{i:04}", "missing", 1 + 40 * i, "40M", "ACGT" * 10, [9] * 40, True, 60, True) for i in range(100)]
    found, n = shuffled_rows(alignments.position_counts(spark.createDataFrame(rows, ALIGN), genome))
    assert sorted((x.pos, x.ref, x.strand, x.base, x.n) for x in found) == [(p, "N", "+", "ACGT"[(p - 1) % 4], 1) for p in range(1, 4001)]
    assert 0 < n <= len(rows) + 1 + len(GENOME)  # one more for the number that begin in a piece
    align = spark.createDataFrame(random_reads(random.Random(3), 200, GENOME), ALIGN)
    whole = sorted(map(tuple, alignments.position_counts(align, genome).collect()))
    monkeypatch.setattr(alignments, "DEEP", 20)
    assert sorted(map(tuple, alignments.position_counts(align, genome).collect())) == whole


@pytest.mark.parametrize("deep", [20, 100_000])
def test_deletions_over_several_pieces(spark, monkeypatch, deep):
    monkeypatch.setattr(alignments, "PIECE", 7)
    monkeypatch.setattr(alignments, "DEEP", deep)
    monkeypatch.setattr(alignments, "HELD", 25)
    cigars = ["4M19D4M", "2M6D2M3I", "3M20N2I3D4M", "2S2M30D4M"]
    rows = [(f"r{i:04}", "c1", 1 + i % 9, cigars[i % 4], "ACGTTGCAG", [i % 40] * 9, i % 2 == 0, 60, True) for i in range(120)]
    genome = spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    got = {(x.chrom, x.pos): (x.ref, x.depth, x.bases, x.quals) for x in alignments.pileup(spark.createDataFrame(rows, ALIGN), genome).collect()}
    want = brute_pileup(rows, GENOME)
    if deep < len(rows):  # parts have an order of their own
        got, want = ({k: (r, d, Counter(b), Counter(q)) for k, (r, d, b, q) in x.items()} for x in (got, want))
    assert got == want


@pytest.mark.parametrize(("deep", "held"), [(1, 4), (9, 1_000_000), (40, 60)])
def test_reads_of_parts_stand_in_order(spark, monkeypatch, deep, held):
    """Deep pieces among others, reads over several of them, and more reads at one start than a part takes."""
    monkeypatch.setattr(alignments, "PIECE", 7)
    r = random.Random(deep)
    rows = random_reads(r, 300, GENOME)
    rows += [(f"h{r.random()}", "c1", 30, "5M9N4M", "ACGTTGCAG", [i % 40] * 9, i % 2 == 0, 60, True) for i in range(90)]
    rows += [("again", "c2", 8, "3M2D4M", "ACGTTGC", [7] * 7, True, 60, True)] * 50
    r.shuffle(rows)
    genome = spark.createDataFrame(list(GENOME.items()), "seqid string, seq string")
    found = lambda rows: {(x.chrom, x.pos): (x.ref, x.depth, x.bases, x.quals) for x in alignments.pileup(spark.createDataFrame(rows, ALIGN).repartition(3), genome).collect()}
    odd = [*rows, *[(None if i % 2 else f"h{i}", None if i % 5 == 0 else "c1", 30 + i % 3, "9M", "ACGTTGCAG", [9] * 9, True, 60, True) for i in range(60)]]
    whole = found(odd)
    monkeypatch.setattr(alignments, "DEEP", deep)
    monkeypatch.setattr(alignments, "HELD", held)
    assert found(rows) == brute_pileup(rows, GENOME)
    assert found(odd) == whole


@pytest.mark.parametrize("far", [[], [("far", "c2", 1, "2M40D2M", "ACGT", [9] * 4, True, 60, True)]])
def test_deletions_in_sequences_of_one_name(spark, monkeypatch, far):
    """A long deletion elsewhere does not change the letters of others, and each sequence has its own."""
    monkeypatch.setattr(alignments, "PIECE", 7)
    genome = spark.createDataFrame([("c1", "ACGTTGCTTTTTTTTT"), ("c1", "ACGTTGCAACGTTTCC"), ("c1", "ACGTTGCAACGTTTCC"), ("c1", "ACGTTGC"), ("c2", "ACGT" * 20)], "seqid string, seq string")
    rows = [("a", "c1", 4, "4M3D3M", "TTGCTTT", [7] * 7, True, 60, True), ("b", "c1", 5, "3M6D1M", "TGCT", [7] * 4, False, 60, True)]
    rows += far and [("c", "c1", 6, "2M9D1M", "GCT", [7] * 3, True, 60, True), *far]
    got = {x.pos: x for x in alignments.pileup(spark.createDataFrame(rows, ALIGN), genome).where("chrom = 'c1'").collect()}
    own, other = [".-3NNN", ".-3AAC", ".-3AAC", ".-3TTT"], [",-6nnnnnn", ",-6aacgtt", ",-6aacgtt", ",-6tttttt"]
    last = [".-9NNNNNNNNN", ".-9AACGTTTCC", ".-9AACGTTTCC", ".-9TTTTTTTTT"] if far else []
    assert (got[7].ref, got[7].depth, got[7].bases) == ("C", 4 * (2 + len(far)), "".join(own + other + last))


def test_parts_are_ranges_of_bounded_size(spark, monkeypatch):
    monkeypatch.setattr(alignments, "DEEP", 50)
    rows = [(f"r{i * 7919 % 1000:04}", "c1", 5 + i % 2 * 3, "4M", "ACGT", [9] * 4, True, 60, True) for i in range(1000)] + [(f"x{i}", "c1", 10_001 + i, "4M", "ACGT", [9] * 4, True, 60, True) for i in range(20)]
    beside, parts = alignments._beside(spark.createDataFrame(rows, ALIGN), spark.createDataFrame([("c1", "ACGT" * 3000)], "seqid string, seq string"))
    sizes, spans = Counter(), defaultdict(list)
    for x in beside.where("more is null").collect():
        sizes[x.piece, x.part] += 1
        spans[x.piece, x.part].append((x.start, x.read_id))
    ranges = [spans[k] for k in sorted(spans)]
    assert parts and len(ranges) > 20 and max(sizes.values()) <= 50 and sum(sizes.values()) == len(rows)
    assert all(max(a) < min(b) for a, b in zip(ranges, ranges[1:], strict=False))


def brute_counts(rows, genome, piece):
    n = Counter()
    for _, c, start, cigar, seq, _, fwd, _, mapped in rows:
        if not mapped or start is None or cigar is None:
            continue
        at, q = start - 1, 0
        for size, op in re.findall(r"(\d+)([MIDNSHP=X])", cigar):
            for j in range(int(size)) if op in "M=XD" else ():
                base, low = "-" if op == "D" else (seq or "")[q + j : q + j + 1].upper(), (at + j) // piece * piece
                for s in [s for d, s in genome if d is not None and d == c and s and len(s) > low] or [""]:
                    if base:
                        n[c, at + j + 1, s[at + j : at + j + 1] or "N", "+" if fwd else "-", base] += 1
            at += int(size) * (op in "MDN=X")
            q += int(size) * (op in "MIS=X")
    return n


@pytest.mark.parametrize(("piece", "held", "batch"), [(7, 5, 3), (10_000, 1_000_000, 10_000), (10_000, 50, 40)])
def test_counts_by_base_of_every_reference_letter(spark, monkeypatch, piece, held, batch):
    monkeypatch.setattr(alignments, "PIECE", piece)
    monkeypatch.setattr(alignments, "HELD", held)
    monkeypatch.setattr(alignments, "ROWS", 11)
    genome = [*GENOME.items(), ("twice", "ACGTTGCATGCA"), ("twice", "ACCTTGGATGCATT"), ("null", None), (None, "ACGT")]
    r = random.Random(piece + held)
    rows = random_reads(r, 150, GENOME)
    for i in range(150):
        cigar = "".join(f"{r.choice([0, 1, 3, 12])}{r.choice('MIDNSHP=X')}" for _ in range(r.randint(0, 5)))
        rows.append((f"x{i}", r.choice(["twice", "twice", "c1", "null", "missing", None]), r.choice([1, 2, 5, 9, 60]), r.choice([cigar, cigar, "4M2D5M", "*", None]), r.choice(["ACGTTGCAGTACGT", "acgtn", "*", "", None, "A\u00e4\U0001f9ecGT" * 3]), [9], r.choice([True, False, None]), 60, r.random() < 0.9))
    r.shuffle(rows)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        found = alignments.position_counts(spark.createDataFrame(rows, ALIGN), spark.createDataFrame(genome, "seqid string, seq string")).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want = brute_counts(rows, genome, piece)
    assert Counter({(x.chrom, x.pos, x.ref, x.strand, x.base): x.n for x in found}) == want and len(found) == len(want)
    assert {k[2] for k in want if k[:2] == ("twice", 3)} == {"G", "C"}


def test_a_region_reads_few_rows_of_a_sorted_table(spark, tmp_path):
    r = random.Random(4)
    rows = [(f"r{i:05}", f"c{i % 4}", 1 + (i * 7919) % 50_000, "20M5N30M", "A" * 50, [30], True, 9, True) for i in range(20_000)] + [(f"u{i}", None, None, "*", "A", [3], True, 0, False) for i in range(50)]
    r.shuffle(rows)
    path = str(tmp_path / "sorted")
    alignments.write_sorted(spark.createDataFrame(rows, ALIGN).repartition(6), path, 8, rows_per_group=500)
    found = alignments.read_region(spark, path, "c2", 20_000, 20_100, longest=55)
    assert {x.read_id for x in found.collect()} == {x[0] for x in rows if x[1] == "c2" and x[2] <= 20_100 and x[2] + 54 >= 20_000}
    scan = found._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert scan.metrics().get("numOutputRows").get().value() <= 2_000
    whole = spark.read.parquet(path)
    assert whole.count() == len(rows)
    parts = whole.where("chrom is not null").groupBy(F.col("_metadata.file_path").alias("f")).agg(F.min(F.struct("chrom", "start")).alias("a"), F.max(F.struct("chrom", "start")).alias("z")).orderBy("a").collect()
    assert all(x.z <= y.a for x, y in zip(parts, parts[1:], strict=False))


def brute_networks(counts):
    """Leads by walking from the most frequent identifier on."""
    near = lambda a, b: len(a) == len(b) and sum(x != y for x, y in zip(a, b, strict=True)) == 1
    led = {}
    for head in sorted(counts, key=lambda u: (-counts[u], u)):
        if head in led:
            continue
        seen, todo = {head}, [head]
        while todo:
            u = todo.pop()
            for v in counts:
                if v not in seen and near(u, v) and counts[u] >= 2 * counts[v] - 1:
                    seen.add(v)
                    todo.append(v)
        for v in seen:
            led.setdefault(v, head)
    return led


def test_networks(spark):
    r = random.Random(8)
    nodes = []
    for k in range(40):
        alphabet, size = r.choice([("AC", 5), ("ACGT", 3), ("ACGT", 6), ("ACGTN", 4)])
        some = Counter()
        for _ in range(r.randint(1, 60)):
            some["".join(r.choice(alphabet) for _ in range(size))] += r.choice([1, 1, 1, 2, 5, 9, 40])
        nodes += [(f"p{k}", u, n) for u, n in some.items()]
    nodes += [("odd", "", 3), ("odd", "AC", 1), ("odd", "ACG", 1), ("odd", "ACT", 1)]
    ring = ["AAAA", "AAAC", "AACC", "ACCC", "CCCC", "CCCG", "CCGG", "CGGG", "GGGG"]
    nodes += [("chain", u, 1) for u in ring] + [("down", u, 2**k) for k, u in enumerate(ring)]
    got = {(x.place, x.umi): x.lead for x in umis.networks(spark.createDataFrame(nodes, "place string, umi string, n bigint")).collect()}
    by = defaultdict(dict)
    for p, u, n in nodes:
        by[p][u] = n
    assert got == {(p, u): lead for p, some in by.items() for u, lead in brute_networks(some).items()}


def test_a_place_with_most_reads_and_odd_rows(spark):
    hot = [(f"h{i}_{'ACGT'[i % 4]}{'AC'[i % 2]}GT", "c1", 100, "10M", "A" * 10, [30] * 10, True, i % 3, True) for i in range(600)]
    clipped = [("s1_AAAA", "c1", 103, "3S7M", "A" * 10, [30] * 10, True, 60, True), ("s2_AAAA", "c1", 80, "10M2I5M1D4M3S", "A" * 24, [30] * 24, False, 60, True), ("s3_AAAA", "c1", 90, "4H13M", "A" * 13, [30] * 13, False, 61, True)]
    odd = [("x", None, None, None, None, None, None, None, False), ("y", "c1", 7, "5M", "A" * 5, [1] * 5, True, None, True), ("y", "c1", 7, "5M", "A" * 5, [1] * 5, True, None, True)]
    got = umis.deduplicate(spark.createDataFrame([*hot, *clipped, *odd], ALIGN)).collect()
    counts = Counter(x[0].split("_")[1] for x in hot) + Counter(["AAAA"])
    led = brute_networks(counts)
    assert {x.umi for x in got if x.chrom == "c1" and x.start in (100, 103)} == set(led.values())
    # The two on the other strand end at the same place, 102 and 102.
    assert sorted((x.read_id, x.molecule_reads) for x in got if not x.fwd) == [("s3_AAAA", 2)]
    assert [(x.molecule_reads, x.umi) for x in got if x.read_id == "y"] == [(2, "")]
    assert umis.deduplicate(spark.createDataFrame([], ALIGN)).count() == 0


def brute_adapter(s, a, rate, overlap):
    best = (-1 << 30, 0, -len(s))
    for i in range(len(s) + 1):
        row = list(range(len(s) - i + 1))
        for p in range(1, len(a) + 1):
            new = [p]
            for j in range(1, len(row)):
                same = s[i + j - 1] == a[p - 1] and s[i + j - 1] != "N"
                new.append(min(row[j - 1] + (not same), row[j] + 1, new[j - 1] + 1))
            row = new
            d = row[-1] if p < len(a) else min(row)
            if (p >= overlap or p == len(a)) and d <= int(rate * p + 1e-9):
                best = max(best, (p - d, -d, -i))
    return -best[2]


@settings(max_examples=300, deadline=None)
@given(reads=st.lists(st.text("ACGTN", max_size=30), min_size=1, max_size=5), adapter=st.text("ACGT", min_size=1, max_size=12), rate=st.sampled_from([0.0, 0.1, 0.2, 0.34, 0.5]), overlap=st.integers(1, 4))
def test_adapter_with_errors(reads, adapter, rate, overlap):
    reads = [*reads, reads[0] + adapter[: len(adapter) // 2 + 1], reads[0][:9] + adapter + reads[-1]]
    got = find_adapter([x.encode() for x in reads], adapter.encode(), rate, overlap)
    assert got.tolist() == [brute_adapter(x, adapter, rate, overlap) for x in reads]


def test_clip_tolerant(spark):
    r = random.Random(2)
    adapter = "TGGAATTCTCGGGTGCCAAGGAACTCCAGTCACTGACCATAGCTAGCATCGACTACGATCA"
    rows = []
    for i in range(60):
        own = "".join(r.choice("ACGT") for _ in range(r.randint(0, 40)))
        bad = list(adapter)
        for _ in range(r.randint(0, 6)):
            bad[r.randrange(len(bad))] = r.choice(["", "A", "CG", "N"])
        rows.append((f"r{i}", own + "".join(bad)[: r.randint(0, 70)]))
    rows += [("n", None), ("e", ""), ("long", "ACGT" * 5000 + adapter[:30]), ("low", "acgtacgta" + adapter[:20].lower())]
    df = spark.createDataFrame([(*x, x[1], "k") for x in rows], "id string, seq string, qual string, _x string")
    got = {x.id: x.seq for x in trimming.clip_tolerant(df, adapter, 0.15, 4).collect()}
    assert got == {i: s and s[: brute_adapter(s.upper(), adapter, 0.15, 4) if len(s) < 200 else 20_000] for i, s in rows}
    assert trimming.clip_tolerant(df, adapter, 0.15, 4, min_length=10).count() == sum(len(s or "") >= 10 for s in got.values())
    with pytest.raises(ValueError, match="63"):
        trimming.clip_tolerant(df, "A" * 64)


def test_the_adapter_query(spark):
    from pathlib import Path

    from bindery.plans import genomic_queries
    from bindery.plans.views import views

    sf = "/root/testdata/sf0.001"
    if not Path(sf).is_dir():
        pytest.skip("needs the generated tables")
    got = {x.read_id: x.seq for x in genomic_queries.queries()["adapter_tolerant"](spark, sf).collect()}
    assert got == {x.read_id: x.seq[: brute_adapter(x.seq, "TGGAATTCTC", 0.2, 3)] for x in views(spark, sf)["v_reads"].collect()}


def test_trimming_matches_loops(spark):
    r = random.Random(6)
    rows = [[r.randint(0, 40) for _ in range(r.randint(0, 25))] for _ in range(200)] + [[], [2] * 8, [40] * 8, [28] * 5]
    df = spark.createDataFrame([(i, q) for i, q in enumerate(rows)], "id int, quals array<int>")
    q = F.col("quals")
    got = df.select("id", trimming.trimmed_end(q, 28).alias("e"), trimming.trimmed_sum(q, 28).alias("s"), trimming.best_segment(q, 28).alias("g")).collect()
    for x in got:
        quals = rows[x.id]
        end = len(quals)
        while end and quals[end - 1] < 28:
            end -= 1
        total = best = 0
        cut = len(quals)
        for k in range(len(quals) - 1, -1, -1):
            total += 28 - quals[k]
            if total < 0:
                break
            if total > best:
                best, cut = total, k
        sums = [(sum(quals[a:b]) - 28 * (b - a), a, b) for a in range(len(quals)) for b in range(a + 1, len(quals) + 1)]
        top = max((s for s, _, _ in sums), default=0)
        assert (x.e, x.s) == (end, cut)
        assert top <= 0 and (x.g.begin, x.g.end) == (0, 0) or (sum(quals[x.g.begin : x.g.end]) - 28 * (x.g.end - x.g.begin) == top and x.g.end == min(b for s, _, b in sums if s == top))


def test_trim_quality(spark):
    df = spark.createDataFrame([("a", "ACGTACGT", "IIII!!I!"), ("b", "", ""), ("c", None, None), ("d", "AC", "!!")], "id string, seq string, qual string")
    assert {x.id: x.seq for x in trimming.trim_quality(df, 30).collect()} == {"a": "ACGTACG", "b": "", "c": None, "d": ""}
    assert {x.id: x.qual for x in trimming.trim_quality(df, 30, mode="sum").collect()} == {"a": "IIII", "b": "", "c": None, "d": ""}
    assert {x.id: x.seq for x in trimming.trim_quality(df, 30, mode="segment").collect()} == {"a": "ACGT", "b": "", "c": None, "d": ""}
    assert {x.id for x in trimming.trim_quality(df, 30, min_length=3).collect()} == {"a"}


def brute_clip(x, edge):
    """Clipped start, cigar, md, nm of a read with gaps, letter by letter."""
    start, cigar, md, nm = x
    ops = [(int(n), o) for n, o in re.findall(r"(\d+)([A-Z=])", cigar)]
    s, e = (ops[0][0] if ops[0][1] == "S" else 0), (ops[-1][0] if ops[-1][1] == "S" else 0)
    core = ops[bool(s) : len(ops) - bool(e)]
    # The tag letter by letter: what stands before each aligned letter (a deletion), and the reference letter of a mismatch.
    letters, ahead = [], ""
    for t in re.findall(r"[0-9]+|\^[A-Z]+|[A-Z]", md):
        if t[0] == "^":
            ahead = t
        elif t[0].isdigit():
            for _ in range(int(t)):
                letters.append((ahead, ""))
                ahead = ""
        else:
            letters.append((ahead, t))
            ahead = ""
    bad = [k for k, (_, m) in enumerate(letters) if m]
    cl = max((k + 1 for k in bad if k < edge), default=0)
    cr = max((len(letters) - k for k in bad if k >= len(letters) - edge), default=0)
    if cl >= core[0][0] or cr >= core[-1][0]:
        return x
    rest = letters[cl : len(letters) - cr]
    out, run = "", 0
    for gone, m in rest:
        if gone:
            out, run = out + str(run) + gone, 0
        if m:
            out, run = out + str(run) + m, 0
        else:
            run += 1
    core[0], core[-1] = (core[0][0] - cl, "M"), (core[-1][0] - cr, "M")
    new = ([(s + cl, "S")] if s + cl else []) + core + ([(e + cr, "S")] if e + cr else [])
    return start + cl, "".join(f"{n}{o}" for n, o in new), out + str(run), nm - (len(bad) - sum(bool(m) for _, m in rest))


def test_clipped_edges_of_reads_with_gaps(spark):
    from bindery.operators import reads

    r = random.Random(13)
    rows = []
    for i in range(300):
        blocks = [r.randint(1, 9) for _ in range(r.randint(2, 4))]
        gaps = [(r.randint(1, 3), r.choice("IDN")) for _ in blocks[1:]]
        cigar = (f"{r.randint(1, 4)}S" if r.random() < 0.5 else "") + f"{blocks[0]}M" + "".join(f"{n}{o}{b}M" for (n, o), b in zip(gaps, blocks[1:], strict=True)) + (f"{r.randint(1, 4)}S" if r.random() < 0.5 else "")
        md, run, nm = "", 0, sum(n for n, o in gaps if o in "ID")
        for k, b in enumerate(blocks):
            if k and gaps[k - 1][1] == "D":
                md, run = md + f"{run}^{'ACG'[: gaps[k - 1][0]]}", 0
            for _ in range(b):
                if r.random() < 0.25:
                    md, run, nm = md + f"{run}{r.choice('ACGT')}", 0, nm + 1
                else:
                    run += 1
        rows.append((i, 100 + i, cigar, md + str(run), nm))
    df = spark.createDataFrame([(i, a, c, m, n, "A" * sum(int(x) for x, o in re.findall(r"(\d+)([MIS])", c))) for i, a, c, m, n in rows], "read_id long, start long, cigar string, md string, nm int, seq string")
    got = {x.read_id: (x.start, x.cigar, x.md, x.nm) for x in reads.clip_edges(df, 3).collect()}
    want = {i: brute_clip((a, c, m, n), 3) for i, a, c, m, n in rows}
    assert sum(want[x[0]] != x[1:] for x in rows) > 100
    assert got == want
