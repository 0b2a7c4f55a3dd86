"""Binary alignments (BAM) in blocks of BGZF, read in splits without another library.

Spark's text reader cuts files at the four bytes that begin each block, so rows are blocks, files are split like any others,
and any store that Spark reads will do. A task inflates the blocks of its split and looks for the first place from
which records follow each other to the end. Its bytes before that, and those after its last whole record, meet
those of the file's other splits in one group, at most two short pieces for each. There the pieces must make whole
records, from the header on; so if a place had been taken for a record that is none, reading fails and nothing is made up.
"""

from __future__ import annotations

import itertools
import struct
import zlib
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: what begins a block, operations and letters by their codes, sizes of number tags.
MAGIC = b"\x1f\x8b\x08\x04"
OPS, LETTERS = "MIDNSHP=X", "=ACMGRSVTWYHKDBN"
SIZES = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
NUMBERS = {"c": "<b", "C": "<B", "s": "<h", "S": "<H", "i": "<i", "I": "<I"}
HEAD = struct.Struct("<iiiBBHHHiiii")
PAIRS = [a + b for a in LETTERS for b in LETTERS]
SCHEMA = pa.schema([
    ("read_id", pa.string()), ("flag", pa.int32()), ("chrom", pa.string()), ("start", pa.int64()), ("cigar", pa.string()), ("seq", pa.string()), ("quals", pa.list_(pa.int32())),
    ("mapped", pa.bool_()), ("fwd", pa.bool_()), ("nm", pa.int32()), ("md", pa.string()), ("mapq", pa.int32()),
])
ROWS = 4096


def _inflate(rows: Iterator[bytes], whole: bool = True) -> Iterator[bytes]:
    """Contents of blocks, given what stands between their first bytes. A row that is shorter than its block holds those bytes in
    its data, and the next row goes on."""
    held = b""
    for row in rows:
        held = held + MAGIC + row if held else MAGIC + row if row else b""
        if len(held) < 18:
            continue
        extra = struct.unpack_from("<H", held, 10)[0]
        at, size = 12, None
        while at + 4 <= 12 + extra:
            kind, n = held[at : at + 2], struct.unpack_from("<H", held, at + 2)[0]
            if kind == b"BC":
                size = struct.unpack_from("<H", held, at + 4)[0] + 1
            at += 4 + n
        if size is None:
            raise ValueError("not a BGZF file")
        if len(held) < size:
            continue
        if len(held) > size:
            raise ValueError("a BGZF block is longer than it says")
        out = zlib.decompress(held[12 + extra : size - 8], -15)
        if (zlib.crc32(out), len(out)) != struct.unpack_from("<II", held, size - 8):
            raise ValueError("a BGZF block is damaged")
        held = b""
        yield out
    if held and whole:
        raise ValueError("a BGZF block is cut off")


def _header(data: bytes) -> tuple[list[str], int] | None:
    """Names of the references, and the length of the header; None if it does not end here."""
    if len(data) >= 4 and data[:4] != b"BAM\x01":
        raise ValueError("not a BAM file")
    try:
        at = 8 + struct.unpack_from("<i", data, 4)[0]
        n = struct.unpack_from("<i", data, at)[0]
        at, names = at + 4, []
        for _ in range(n):
            size = struct.unpack_from("<i", data, at)[0]
            name = data[at + 4 : at + 4 + size]
            at += 8 + size
            names.append(name.rstrip(b"\0").decode())
    except struct.error:
        return None
    return (names, at) if at <= len(data) else None


def _looks_right(data: bytes, at: int, references: int) -> int:
    """Size of the record at a place with its length field: 0 if there cannot be one, -1 if it does not end here."""
    if len(data) - at < 36:
        return -1
    size, ref, pos, name, _, _, ops, _, letters, ref2, pos2, _ = HEAD.unpack_from(data, at)
    if not (-1 <= ref < references and -1 <= ref2 < references and pos >= -1 and pos2 >= -1 and name >= 1 and letters >= 0 and size >= 32 + name + 4 * ops + (letters + 1) // 2 + letters):
        return 0
    text = data[at + 36 : at + 35 + name]
    if any(not 33 <= c <= 126 for c in text) or (at + 35 + name < len(data) and data[at + 35 + name] != 0):
        return 0
    return size + 4 if at + size + 4 <= len(data) else -1


def _records(data: bytes, at: int, references: int) -> tuple[list[int], int]:
    """Places of the whole records that follow each other from a place, and where the next begins; none if one cannot be."""
    found = []
    while (size := _looks_right(data, at, references)) > 0:
        found.append(at)
        at += size
    return (found, at) if size < 0 or at == len(data) else ([], at)


def _first(data: bytes, references: int) -> tuple[list[int], int]:
    """The same from the first place where at least one whole record stands and nothing after it contradicts."""
    for at in range(len(data)):
        if _looks_right(data, at, references) > 0:
            found, end = _records(data, at, references)
            if found:
                return found, end
    return [], 0


def _tags(data: bytes, at: int, end: int) -> dict[str, object]:
    """The tags NM, MD and CG."""
    out: dict[str, object] = {}
    while at + 3 <= end:
        name, kind = data[at : at + 2].decode("latin-1"), chr(data[at + 2])
        at += 3
        if kind in "ZH":
            stop = data.index(b"\0", at)
            value: object = data[at:stop]
            at = stop + 1
        elif kind == "B":
            part, n = chr(data[at]), struct.unpack_from("<i", data, at + 1)[0]
            value = data[at + 5 : at + 5 + n * SIZES[part]]
            at += 5 + n * SIZES[part]
        else:
            value = struct.unpack_from(NUMBERS[kind], data, at)[0] if kind in NUMBERS else None
            at += SIZES[kind]
        if name in ("NM", "MD", "CG"):
            out[name] = value
    return out


def _alignment(data: bytes, at: int, names: list[str]) -> tuple:
    size, ref, pos, name, mapq, _, ops, flag, letters, _, _, _ = HEAD.unpack_from(data, at)
    read_id = data[at + 36 : at + 35 + name].decode()
    here = at + 36 + name
    cigar = struct.unpack_from(f"<{ops}I", data, here)
    here += 4 * ops
    seq = "".join([PAIRS[b] for b in data[here : here + (letters + 1) // 2]])[:letters]
    here += (letters + 1) // 2
    quals = list(data[here : here + letters])
    tags = _tags(data, here + letters, at + 4 + size)
    if isinstance(tags.get("CG"), bytes) and ops and cigar[0] == letters << 4 | 4:  # more operations than the field can count
        cigar = struct.unpack(f"<{len(tags['CG']) // 4}I", tags["CG"])
    md = tags.get("MD")
    return (
        read_id, flag, names[ref] if ref >= 0 else "*", pos + 1, "".join(f"{c >> 4}{OPS[c & 15]}" for c in cigar) or "*", seq or "*", [] if quals and quals[0] == 255 else quals,
        not flag & 4, not flag & 16, tags.get("NM") or 0, md.decode() if isinstance(md, bytes) else "", mapq,
    )


def _table(rows: list[tuple], edges: list[tuple]) -> pa.RecordBatch:
    """Alignments, and pieces of records (file, block, place, piece) in rows of their own."""
    kinds = [pa.string(), pa.int64(), pa.int32(), pa.binary()]
    whole = [pa.array([r[k] for r in rows] + [None] * len(edges), f.type) for k, f in enumerate(SCHEMA)]
    parts = [pa.array([None] * len(rows) + [e[k] for e in edges], t) for k, t in enumerate(kinds)]
    return pa.RecordBatch.from_arrays([*whole, *parts], names=[*SCHEMA.names, "_file", "_block", "_place", "_piece"])


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[bytes]]]:
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for (file, block), some in itertools.groupby(rows, key=lambda r: r[1:]):
        yield file, block, (r[0] for r in some)


def _blocks(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    return rows.select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _references(spark: SparkSession, path: str) -> tuple[str, tuple[str, ...]]:
    """A file as Spark names it, and its references: its first blocks are read, more of them if the header is longer."""
    n, before = 16, -1
    while True:
        some = _blocks(spark, path).where("block = 0").limit(n).collect()
        if len(some) == before:
            raise ValueError(f"{path}: the header is not in the first split")
        data = b""
        for inflated in _inflate((bytes(r["value"]) for r in some), whole=False):
            data += inflated
            if (known := _header(data)) is not None:
                return some[0]["file"], tuple(known[0])
        n, before = n * 4, len(some)


def _decode(names_of: dict[str, int], headers: list[list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, rows in _by_split(batches):
            names = headers[names_of[file]]
            # The bytes that no record has taken yet; the first split begins with the header, another one with part of a record.
            data, sure, out = b"", False, []
            for inflated in _inflate(rows):
                data += inflated
                found, end = [], 0
                if sure:
                    found, end = _records(data, 0, len(names))
                elif block == 0:
                    if (known := _header(data)) is not None:
                        yield _table([], [(file, block, 0, data[: known[1]])])
                        data, sure = data[known[1] :], True
                        found, end = _records(data, 0, len(names))
                else:
                    found, end = _first(data, len(names))
                    if found:
                        yield _table([], [(file, block, 0, data[: found[0]])])
                        sure = True
                if sure and not found and len(data) >= 36 and _looks_right(data, 0, len(names)) == 0:
                    raise ValueError(f"{file}: a record cannot be read")
                out += [_alignment(data, at, names) for at in found]
                data = data[end:] if found else data
                if len(out) >= ROWS:
                    yield _table(out, [])
                    out = []
            yield _table(out, [(file, block, 1 if sure else 0, data)] if data else [])

    return run


def _rest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Records that lie across splits, from the pieces of a file in order."""
    data = b"".join(pdf.sort_values(["_block", "_place"])["_piece"])
    file = pdf["_file"].iloc[0]
    known = _header(data)
    if known is None:
        raise ValueError(f"{file}: the header is cut off")
    found, end = _records(data, known[1], len(known[0]))
    if end != len(data):
        raise ValueError(f"{file}: records do not fit together")
    return pd.DataFrame([_alignment(data, at, known[0]) for at in found], columns=SCHEMA.names)


def read_bam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments as the read operators take them: read_id, flag, chrom, start, cigar, seq, quals, mapped, fwd, nm, md, mapq.

    Missing references and strings are `*`, missing qualities an empty array, a missing MD tag is empty, as in SAM text. The first
    blocks of each file are read ahead for its references, which go to all tasks once for each different list. A file that is
    damaged or cut off fails."""
    rows = _blocks(spark, path)
    found = dict(_references(spark, f) for f in rows.inputFiles())
    headers = sorted(set(found.values()))
    names_of, lists = {f: headers.index(h) for f, h in found.items()}, [list(h) for h in headers]
    fields = "read_id string, flag int, chrom string, start bigint, cigar string, seq string, quals array<int>, mapped boolean, fwd boolean, nm int, md string, mapq int"
    decoded = rows.mapInArrow(_decode(names_of, lists), f"{fields}, _file string, _block bigint, _place int, _piece binary")
    rest = decoded.where("_piece is not null").select("_file", "_block", "_place", "_piece").groupBy("_file").applyInPandas(_rest, fields)
    return decoded.where("_piece is null").select(*SCHEMA.names).unionByName(rest)
