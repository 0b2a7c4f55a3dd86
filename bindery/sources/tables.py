"""Text formats: readers parse lines inside Spark; writers keep the order of the rows."""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.functions.sequences import revcomp

#: The columns that a site table must begin with.
SITE_COLUMNS = {"seqid": "string", "position": "bigint", "transitions": "int", "coverage": "int", "score": "double", "strand": "string", "occupancy": "double"}
LEGACY_COLUMNS = {"chromosome": "string", "position": "bigint", "m": "int", "r": "int", "pvalue": "double", "strand": "string", "occ": "double"}
GFF_COLUMNS = ("seqid", "source", "type", "start_pos", "end_pos", "score", "strand", "phase")
PILEUP_COLUMNS = {"chrom": "string", "pos": "bigint", "ref": "string", "depth": "int", "bases": "string", "quals": "string"}


def _field(parts: Column, i: int, kind: str) -> Column:
    value = F.when(parts[i] != ".", parts[i])
    return value if kind == "string" else value.try_cast(kind)


def parse_sites(lines: DataFrame, header: list[str], converters: dict | None = None) -> DataFrame:
    """Site rows of tab-separated lines (column `value`); `.` is null, rows of another width are skipped, extra
    columns are strings unless `converters` maps their name to a function of the column."""
    if list(header[: len(SITE_COLUMNS)]) != list(SITE_COLUMNS):
        raise ValueError(f"a site table begins with the columns {', '.join(SITE_COLUMNS)}")
    parts = F.split("value", "\t", -1)
    cols = []
    for i, name in enumerate(header):
        c = _field(parts, i, SITE_COLUMNS.get(name, "string"))
        cols.append((converters[name](c) if converters and name in converters else c).alias(name))
    return lines.where((F.size(parts) == len(header)) & (F.col("value") != "\t".join(header))).select(*cols)


def read_sites(spark: SparkSession, path: str, converters: dict | None = None) -> DataFrame:
    lines = spark.read.text(path)
    return parse_sites(lines, lines.first()["value"].split("\t"), converters)


def parse_legacy(lines: DataFrame) -> DataFrame:
    """Legacy rows: seven fields, others skipped, and so is the header."""
    parts = F.split("value", "\t", -1)
    return lines.where((F.size(parts) == 7) & ~F.col("value").startswith("chromosome\t")).select(*[_field(parts, i, k).alias(c) for i, (c, k) in enumerate(LEGACY_COLUMNS.items())])


def read_legacy(spark: SparkSession, path: str) -> DataFrame:
    return parse_legacy(spark.read.text(path))


def parse_gff(lines: DataFrame) -> DataFrame:
    """GFF3 rows: comments and rows without nine fields are skipped, `.` is null, attributes are a map of
    URL-decoded values; what is not key=value goes to `annot` as it is."""
    parts = F.split("value", "\t", -1)
    kinds = {"start_pos": "bigint", "end_pos": "bigint", "score": "double", "phase": "int"}
    raw = parts[8]
    decoded = F.transform_values(F.str_to_map(raw, F.lit(";"), F.lit("=")), lambda _, v: F.try_url_decode(v))
    attributes = F.when(raw.rlike(r"^\s*[^=;]+=[^=;]*(;[^=;]+=[^=;]*)*;?\s*$"), F.map_filter(decoded, lambda k, _: k != "")).otherwise(F.create_map(F.lit("annot"), raw))
    return lines.where(~F.col("value").startswith("#") & (F.size(parts) == 9)).select(*[_field(parts, i, kinds.get(c, "string")).alias(c) for i, c in enumerate(GFF_COLUMNS)], attributes.alias("attributes"))


def read_gff(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_gff(spark.read.text(path))


def info_part(info: Column, after: str, before: str) -> Column:
    """What stands between two strings in a GFF info field."""
    return F.split_part(F.split_part(info, F.lit(after), F.lit(2)), F.lit(before), F.lit(1))


def read_pileup(spark: SparkSession, path: str) -> DataFrame:
    """samtools mpileup rows; quoting characters are data."""
    parts = F.split("value", "\t", -1)
    return spark.read.text(path).where(F.size(parts) == 6).select(*[parts[i].try_cast(k).alias(c) for i, (c, k) in enumerate(PILEUP_COLUMNS.items())])


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """seqid (first word of the header), seq in upper case. A record is read whole: Spark splits at ">" line starts."""
    records = spark.read.text(path, lineSep="\n>")
    body = F.regexp_replace("value", "^>", "")
    lines = F.split(body, "\n")
    return records.where(body != "").select(F.split(lines[0], r"\s")[0].alias("seqid"), F.upper(F.regexp_replace(F.concat_ws("", F.slice(lines, 2, F.size(lines))), r"\s", "")).alias("seq"))


def _split_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with the file and the split that they were read from; a task reads the lines of a split in order."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _by_split(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, Iterator[str]]]:
    """(file, block, lines) of each split."""
    rows = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    for (file, block), some in itertools.groupby(rows, key=lambda r: r[1:]):
        yield file, block, (r[0] or "" for r in some)


def _fasta_summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """file, block, name of the last header (null: none), letters after it or in all of the split."""
    out = []
    for file, block, lines in _by_split(batches):
        name, letters = None, 0
        for line in lines:
            if line.startswith(">"):
                name, letters = (line[1:].split() or [""])[0], 0
            else:
                letters += len(line.strip())
        out.append((file, block, name, letters))
    yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], t) for k, t in enumerate((pa.string(), pa.int64(), pa.string(), pa.int64()))], names=["file", "block", "name", "letters"])


def _fasta_pieces(chunk: int, before: dict[tuple[str, int], tuple[str | None, int]]):
    """seqid, chunk, at, seq: the letters of lines, cut at multiples of `chunk`. before: (file, block) -> the sequence
    that goes on there, and the letters of it that came before."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int64(), pa.string()))], names=["seqid", "chunk", "at", "seq"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for file, block, lines in _by_split(batches):
            name, start = before[(file, block)]
            out, text = [], []
            for line in itertools.chain(lines, [">"]):
                if not line.startswith(">"):
                    text.append(line.strip())
                if line.startswith(">") or len(text) >= 4096:
                    whole = "".join(text).upper()
                    text = []
                    while whole:
                        n = chunk - start % chunk
                        out.append((name, start // chunk, start % chunk, whole[:n]))
                        start += len(whole[:n])
                        whole = whole[n:]
                    if len(out) >= 256:
                        yield table(out)
                        out = []
                if line.startswith(">"):
                    name, start = (line[1:].split() or [""])[0], 0
            yield table(out)

    return run


def read_fasta_chunks(spark: SparkSession, path: str, chunk: int = 100_000) -> DataFrame:
    """seqid, chunk_start (1-based), seq: sequences in pieces that joins can spread, in upper case.

    Files are read in splits, so that a chromosome is never one row. A first pass notes for each split the last
    header and the letters after it, one row a split, which tells where every split begins."""
    lines = _split_lines(spark, path)
    notes = sorted(tuple(r) for r in lines.mapInArrow(_fasta_summary, "file string, block bigint, name string, letters bigint").collect())
    before: dict[tuple[str, int], tuple[str | None, int]] = {}
    for _, some in itertools.groupby(notes, key=lambda r: r[0]):
        name, letters = None, 0
        for file, block, last, more in some:
            before[(file, block)] = (name, letters)
            name, letters = (name, letters + more) if last is None else (last, more)
    parts = lines.mapInArrow(_fasta_pieces(chunk, before), "seqid string, chunk bigint, at bigint, seq string").where("seqid is not null")
    # A chunk holds at most `chunk` letters, so its pieces are few.
    whole = parts.groupBy("seqid", "chunk").agg(F.sort_array(F.collect_list(F.struct("at", "seq"))).alias("p"))
    return whole.select("seqid", (F.col("chunk") * chunk + 1).alias("chunk_start"), F.concat_ws("", F.col("p.seq")).alias("seq"))


def fetch(chunks: DataFrame, regions: DataFrame, chunk: int = 100_000) -> DataFrame:
    """regions (seqid, start_pos, end_pos, strand, 1-based closed) with `seq` of their strand; regions that reach out of
    their sequence are dropped. A region joins the chunks it touches, and these alone."""
    named = regions.withColumn("_id", F.xxhash64("seqid", "start_pos", "end_pos", "strand"))
    asked = named.select("_id", "seqid", "start_pos", "end_pos").distinct().where("start_pos >= 1 and start_pos <= end_pos")
    touched = asked.withColumn("chunk_start", F.explode(F.transform(F.sequence(F.floor((F.col("start_pos") - 1) / chunk), F.floor((F.col("end_pos") - 1) / chunk)), lambda c: c * chunk + 1)))
    first = F.greatest(F.col("start_pos") - F.col("chunk_start"), F.lit(0))
    piece = F.substring(F.col("seq"), (first + 1).cast("int"), (F.col("end_pos") - F.col("chunk_start") + 1 - first).cast("int"))
    got = touched.join(chunks, ["seqid", "chunk_start"]).select("_id", "seqid", "start_pos", "end_pos", F.struct("chunk_start", piece.alias("s")).alias("p"))
    whole = got.groupBy("_id", "seqid", "start_pos", "end_pos").agg(F.sort_array(F.collect_list("p")).alias("p")).withColumn("seq", F.concat_ws("", F.col("p.s")))
    whole = whole.where(F.length("seq") == F.col("end_pos") - F.col("start_pos") + 1).select("_id", "seq")
    return named.join(whole, "_id").withColumn("seq", F.when(F.col("strand") == "-", revcomp(F.col("seq"))).otherwise(F.col("seq"))).drop("_id")


def check_index(chunks: DataFrame, index: DataFrame) -> DataFrame:
    """Sequences whose length is not that of the index, or that one of the two lacks; none if the index is sound."""
    lengths = chunks.groupBy("seqid").agg(F.sum(F.length("seq")).alias("found"))
    return lengths.join(index.select("seqid", "length"), "seqid", "full").where(~F.col("found").eqNullSafe(F.col("length")))


def read_fai(spark: SparkSession, path: str) -> DataFrame:
    """Rows of a FASTA index; a row without five fields raises at run time."""
    parts = F.split("value", "\t", -1)
    good = F.when(F.size(parts) == 5, parts[0]).otherwise(F.raise_error(F.lit("corrupt FASTA index")).cast("string"))
    return spark.read.text(path).select(good.alias("seqid"), *[parts[i].cast("bigint").alias(c) for i, c in enumerate(("length", "offset", "linebases", "linewidth"), 1)])


RECORDS = "file string, block bigint, place int, lines array<string>"
LETTERS = re.compile(r"[A-Za-z.*-]*\r?")


def _begins(lines: list[str], i: int) -> bool:
    """Whether a record begins at line i: a quality line that looks like a header is not followed by letters."""
    return lines[i].startswith("@") and LETTERS.fullmatch(lines[i + 1]) is not None and lines[i + 2].startswith("+") and len(lines[i + 1]) == len(lines[i + 3])


def _fastq_records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole records of a split (place 1), what comes before the first (0) and after the last (2); all, if none is whole (1 is missing)."""

    def table(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.int64(), pa.int32(), pa.list_(pa.string())))], names=["file", "block", "place", "lines"])

    for file, block, lines in _by_split(batches):
        held, found, out = [], False, []
        for line in lines:
            held.append(line)
            if not found and len(held) >= 4 and _begins(held, len(held) - 4):
                found = True
                if held[:-4]:
                    out.append((file, block, 0, held[:-4]))
                held = held[-4:]
            if found and len(held) == 4:
                out.append((file, block, 1, held))
                held = []
            if len(out) >= 4096:
                yield table(out)
                out = []
        if held:
            out.append((file, block, 2 if found else 0, held))
        yield table(out)


def _fastq_rest(pdf: pd.DataFrame) -> pd.DataFrame:
    """Records that lie across splits, from the pieces of a file in order: at most two a split."""
    lines = [x for r in pdf.sort_values(["block", "place"])["lines"] for x in r]
    lines = [x for k, x in enumerate(lines) if x or k % 4 in (1, 3)]  # empty lines between records, but not empty reads
    return pd.DataFrame({"lines": [lines[k : k + 4] for k in range(0, len(lines) - 3, 4)]})


def read_fastq(spark: SparkSession, path: str) -> DataFrame:
    """id, seq, plus, qual of four-line records. Files are read in splits: a task finds where records begin, and the
    pieces of records at the edges of splits, at most two for each, meet in one group a file."""
    pieces = _split_lines(spark, path).mapInArrow(_fastq_records, RECORDS)
    rest = pieces.where("place <> 1").groupBy("file").applyInPandas(_fastq_rest, "lines array<string>")
    each = pieces.where("place = 1").select("lines").unionByName(rest)
    clean = lambda i: F.regexp_replace(F.col("lines")[i], r"\r$", "")
    return each.select(F.substring(clean(0), 2, 1 << 30).alias("id"), clean(1).alias("seq"), clean(2).alias("plus"), clean(3).alias("qual"))


def read_sam(spark: SparkSession, path: str) -> DataFrame:
    """Alignments of SAM text as the read operators take them."""
    p = F.split("value", "\t", -1)
    tag = lambda t: F.regexp_extract("value", rf"\t{t}:[A-Za-z]:([^\t]*)", 1)
    flag = p[1].cast("int")
    quals = F.transform(F.split(p[10], ""), lambda c: F.ascii(c) - 33)
    return spark.read.text(path).where(~F.col("value").startswith("@") & (F.size(p) >= 11)).select(
        p[0].alias("read_id"), flag.alias("flag"), p[2].alias("chrom"), p[3].cast("bigint").alias("start"), p[5].alias("cigar"), p[9].alias("seq"), quals.alias("quals"),
        (flag.bitwiseAND(4) == 0).alias("mapped"), (flag.bitwiseAND(16) == 0).alias("fwd"), F.coalesce(tag("NM").try_cast("int"), F.lit(0)).alias("nm"), tag("MD").alias("md"), p[4].try_cast("int").alias("mapq"),
    )


def _text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit("."))


def site_lines(sites: DataFrame) -> DataFrame:
    return sites.select(F.concat_ws("\t", *[_text(F.col(c)) for c in sites.columns]).alias("value"))


def write_sites(sites: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """A site table with its header in every part file, in the order given, null as `.`."""
    (sites.orderBy(*order) if order else sites).select(*[_text(F.col(c)).alias(c) for c in sites.columns]).write.csv(path, sep="\t", header=True, quote="", escapeQuotes=False)


def fasta_lines(windows: DataFrame) -> DataFrame:
    """rank, value: records `>seq:i:chrom:pos:strand:occupancy:transitions:ratio` and sequence, for rows with their
    place in `ordinal`, which counts rows of null seq too; these are left out. A zero occupancy leaves the ratio empty."""
    ratio = F.when(F.col("occupancy") != 0, F.bround(F.col("transitions") / F.col("occupancy"), 2))
    head = F.concat_ws(":", F.lit("seq"), F.col("ordinal").cast("string"), "seqid", "position", "strand", F.bround("occupancy", 2), "transitions", F.coalesce(ratio.cast("string"), F.lit("")))
    return windows.where("seq is not null").select(F.col("ordinal").alias("rank"), F.concat(F.lit(">"), head, F.lit("\n"), F.col("seq")).alias("value"))


def write_fasta(windows: DataFrame, path: str) -> None:
    fasta_lines(windows).orderBy("rank").select("value").write.text(path)


def gff_lines(gff: DataFrame) -> DataFrame:
    pairs = F.transform(F.map_entries("attributes"), lambda e: F.concat(e["key"], F.lit("="), F.url_encode(e["value"])))
    return gff.select(F.concat_ws("\t", *[_text(F.col(c)) for c in GFF_COLUMNS], F.concat_ws(";", pairs)).alias("value"))


def write_gff(gff: DataFrame, path: str) -> None:
    gff_lines(gff).write.text(path)


def duplicate_lines(histogram: DataFrame) -> DataFrame:
    """A line of two right-aligned numbers for each multiplicity."""
    return histogram.select(F.format_string("%15d  %15d", "multiplicity", "sequences").alias("value"))


def write_plain(df: DataFrame, path: str, order: list[Column] | None = None) -> None:
    """Values separated by tabs, without a header and without quotes, in the order given: count, k-mer and matrix tables. Null is empty;
    an array, a row of a matrix, is spread over columns of its own."""
    columns = [F.array_join(F.transform(F.col(c), lambda x: x.cast("string")), "\t", "") if t.startswith("array") else F.coalesce(F.col(c).cast("string"), F.lit("")) for c, t in df.dtypes]
    (df.orderBy(*order) if order else df).select(F.concat_ws("\t", *columns)).write.text(path)
