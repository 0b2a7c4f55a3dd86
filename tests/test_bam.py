"""Binary alignments written here block by block, and read by Spark in splits of any size."""

import random
import re
import struct
import zlib

import pytest

from bindery.sources import bam
from bindery.sources.tables import read_sam

NAMES = ["chr1", "chr2_long", "M"]


def block(data):
    c = zlib.compressobj(6, zlib.DEFLATED, -15)
    body = c.compress(data) + c.flush()
    return b"\x1f\x8b\x08\x04" + struct.pack("<IBBH2sHH", 0, 0, 255, 6, b"BC", 2, len(body) + 25) + body + struct.pack("<II", zlib.crc32(data), len(data))


def record(x):
    name, flag, chrom, start, mapq, cigar, seq, qual, tags = x
    ops = [(int(n) << 4) | "MIDNSHP=X".index(o) for n, o in re.findall(r"(\d+)([MIDNSHP=X])", cigar)]
    s = "" if seq == "*" else seq
    codes = [bam.LETTERS.index(c) for c in s] + [0]
    packed = bytes(codes[i] << 4 | codes[i + 1] for i in range(0, len(s), 2))
    body = struct.pack("<iiBBHHHiiii", NAMES.index(chrom) if chrom != "*" else -1, start - 1, len(name) + 1, mapq, 0, len(ops), flag, len(s), -1, -1, 0)
    body += name.encode() + b"\0" + struct.pack(f"<{len(ops)}I", *ops) + packed + (b"\xff" * len(s) if qual == "*" else bytes(ord(c) - 33 for c in qual))
    for t, kind, v in tags:
        body += t.encode() + kind.encode() + (v.encode() + b"\0" if kind == "Z" else struct.pack("<ci4H", b"S", 4, 1, 2, 3, 4) if kind == "B" else struct.pack(bam.NUMBERS.get(kind, "<f"), v))
    return struct.pack("<i", len(body)) + body


def written(path, rows, size):
    """A file whose blocks hold `size` bytes each, with no regard to where records begin."""
    text = b"@HD\tVN:1.6\n"
    data = b"BAM\x01" + struct.pack("<i", len(text)) + text + struct.pack("<i", len(NAMES)) + b"".join(struct.pack("<i", len(n) + 1) + n.encode() + b"\0" + struct.pack("<i", 9999) for n in NAMES)
    data += b"".join(map(record, rows))
    path.write_bytes(b"".join(block(data[k : k + size]) for k in range(0, len(data), size)) + block(b""))


def line(x):
    kinds = {"C": "i", "i": "i", "f": "f", "Z": "Z"}
    tags = [f"{t}:{kinds[k]}:{v}" for t, k, v in x[8] if k != "B"]
    return "\t".join([x[0], str(x[1]), x[2], str(x[3]), str(x[4]), x[5], "*", "0", "0", x[6], x[7], *tags])


def some_rows(n, seed=1):
    r = random.Random(seed)
    rows = []
    for i in range(n):
        k = r.randint(1, 60)
        seq = "".join(r.choice("ACGTN") for _ in range(k))
        tags = [("NM", r.choice("Ci"), r.randint(0, 9)), ("XF", "f", 0.5), ("MD", "Z", f"{k}"), ("XB", "B", None)]
        r.shuffle(tags)
        rows.append((f"read{i}/{'x' * r.randint(0, 9)}", r.choice([0, 16, 1024]), r.choice(NAMES), r.randint(1, 9000), r.randint(0, 255), f"{k}M", seq, "".join(chr(33 + r.randint(0, 60)) for _ in range(k)), tags[: r.randint(0, 4)]))
    rows.append(("unmapped", 4, "*", 0, 0, "*", "ACG", "III", []))
    rows.append(("bare", 4, "*", 0, 0, "*", "*", "*", []))
    rows.append(("gapped", 16, "chr1", 5, 60, "3H2S5M1I2D4M3N2=1X3S", "A" * 18, "I" * 18, []))
    return rows


def as_sam(spark, path, rows):
    path.write_text("@HD\tVN:1.6\n" + "\n".join(map(line, rows)) + "\n")
    out = []
    for x in read_sam(spark, str(path)).collect():
        quals = [] if x.seq == "*" else x.quals
        out.append(str((x.read_id, x.flag, x.chrom, x.start, x.cigar, x.seq, [q for q in quals], x.mapped, x.fwd, x.nm, x.md, x.mapq)))
    return sorted(out)


def as_bam(spark, path):
    return sorted(str((x.read_id, x.flag, x.chrom, x.start, x.cigar, x.seq, list(x.quals), x.mapped, x.fwd, x.nm, x.md, x.mapq)) for x in bam.read_bam(spark, str(path)).collect())


@pytest.mark.parametrize("size,splits", [(60_000, [1 << 27]), (700, [1 << 27, 1000, 4001]), (61, [2500])])
def test_round_trip_in_splits(spark, tmp_path, size, splits):
    rows = some_rows(150)
    written(tmp_path / "a.bam", rows, size)
    want = as_sam(spark, tmp_path / "a.sam", rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for s in splits:
            spark.conf.set("spark.sql.files.maxPartitionBytes", str(s))
            assert as_bam(spark, tmp_path / "a.bam") == want, s
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_every_border_of_a_stream():
    """Wherever a stream of records is cut, the records of the parts and those of the pieces between them are all of them."""
    rows = some_rows(12, seed=5)
    data = b"".join(map(record, rows))
    places, end = bam._records(data, 0, len(NAMES))
    assert len(places) == len(rows) and end == len(data)
    for cut in range(len(data)):
        found, end = bam._first(data[cut:], len(NAMES))
        later = [p - cut for p in places if p >= cut and p in places and (places + [len(data)])[places.index(p) + 1] <= len(data)]
        assert found == later, cut


def test_damage_is_noticed(spark, tmp_path):
    rows = some_rows(20)
    written(tmp_path / "a.bam", rows, 500)
    data = (tmp_path / "a.bam").read_bytes()
    (tmp_path / "cut.bam").write_bytes(data[: len(data) * 2 // 3])
    (tmp_path / "bad.bam").write_bytes(data[:-60] + bytes([data[-60] ^ 1]) + data[-59:])
    for name in ("cut", "bad"):
        with pytest.raises(Exception, match="cut off|damaged|fit together|invalid"):
            bam.read_bam(spark, str(tmp_path / f"{name}.bam")).collect()
    (tmp_path / "none").mkdir()
    written(tmp_path / "none" / "a.bam", [], 500)
    assert bam.read_bam(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "two").mkdir()
    written(tmp_path / "two" / "a.bam", rows[:5], 500)
    written(tmp_path / "two" / "b.bam", rows[5:], 90)
    assert as_bam(spark, tmp_path / "two") == as_sam(spark, tmp_path / "a.sam", rows)
