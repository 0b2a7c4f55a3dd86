"""Alignments as positions on the reference: pileups, and sorted tables with access by region.

Reads are shuffled once, whole, to the piece of the reference that they lie in (a read that crosses a border to each of its pieces).
There they stand behind that piece in order of start, and one pass writes a row for each position as soon as no later read
can reach it; counts by base are made by arrays of a batch of reads. Single bases are never shuffled, so what is moved grows with the
reads and not with their letters.

Columns of alignments: read_id, chrom, start (1-based, of the first aligned base), cigar, seq, quals (array of int), fwd; optional mapq (60).
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.functions.sequences import chunks
from bindery.operators.lineage import cut

#: Letters in a piece of the reference, and reads that begin in one from which on its positions are put together in parts.
PIECE, DEEP = 10_000, 100_000
#: Bases that a pass holds before it writes the positions that are done, and rows and letters that go out at once.
HELD, ROWS, LETTERS = 1_000_000, 20_000, 16_000_000
#: One position in one part; counts have a row for each strand and base.
COLUMN = "chrom string, pos bigint, ref string, part int, depth int, bases string, quals string"
COUNT = "chrom string, pos bigint, ref string, strand string, base string, n bigint"
_OPERATION = re.compile(r"(\d+)([MIDNSHP=X])")
#: Values that a code point can have.
_POINTS = 1 << 21


def reference_length(cigar: Column) -> Column:
    """Letters of the reference that an alignment covers, skips and deletions included."""
    return F.aggregate(F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1)), F.lit(0).cast("long"), lambda a, n: a + n.cast("long"))


def _mapped(align: DataFrame) -> DataFrame:
    known = align if "mapq" in align.columns else align.withColumn("mapq", F.lit(60))
    return known.where("mapped") if "mapped" in align.columns else known


def _pieces(genome: DataFrame, more: int = 0) -> DataFrame:
    """chrom, copy, piece, seq: the reference in pieces, each with `more` letters of what follows; copy tells sequences of one name apart."""
    known = genome.where(F.col("seqid").isNotNull())
    return known.select(F.col("seqid").alias("chrom"), F.xxhash64("seq").alias("copy"), F.posexplode(chunks(F.col("seq"), PIECE, more)).alias("piece", "seq")).withColumn("piece", F.col("piece").cast("long"))


def _deletion() -> Column:
    """Letters of a read's longest deletion."""
    sizes = F.transform(F.regexp_extract_all("cigar", F.lit(r"(\d+)D"), F.lit(1)), lambda n: n.cast("long"))
    return F.when(F.col("cigar").contains("D"), F.array_max(sizes))


def _steps(ends: Column) -> Column:
    """Powers of two up to the size of an array, largest first."""
    return F.filter(F.array(*[F.lit(1 << k) for k in reversed(range(31))]), lambda step: step <= F.array_size(ends))


def _upto(ends: Column, steps: Column, key: Column) -> Column:
    """How many of the sorted ends are not above the key, by halving."""
    return F.aggregate(steps, F.lit(0), lambda n, step: F.when(F.get(ends, n + step - 1) <= key, n + step).otherwise(n))


def _bounds(reads: DataFrame, begun: DataFrame, deep: DataFrame) -> DataFrame:
    """chrom, _home, _ends, _steps, _before for sequences with deep pieces: start and read_id of reads that cut the order of start and read_id
    into ranges of at most DEEP reads of deep pieces (more only where reads tie), and how many such ends lie in earlier pieces. Only
    these keys are sorted, and the ends kept, so that all reads are held against the same ones."""
    order, place = ["chrom", "_home", "start", "read_id"], ["chrom", "_home"]
    keys = reads.join(deep, place, "left_semi").select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    row = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)  # the row's number in its task
    ends = cut(keys.withColumn("_k", row).where(F.col("_k") % DEEP == 0)).groupBy(*place).agg(F.sort_array(F.collect_list(F.struct("start", "read_id"))).alias("_ends"))
    homes = begun.select(*place).join(deep.select("chrom").distinct(), "chrom", "left_semi").join(ends, place, "left")
    earlier = Window.partitionBy("chrom").orderBy("_home").rowsBetween(Window.unboundedPreceding, -1)
    return homes.withColumns({"_steps": _steps(F.col("_ends")), "_before": F.coalesce(F.sum(F.array_size("_ends")).over(earlier), F.lit(0))})


def _beside(align: DataFrame, genome: DataFrame, counted: bool = False) -> tuple[DataFrame, bool]:
    """Reads behind the pieces of the reference that they lie in, one group for each chrom, piece and part: first the piece (`more` 0),
    then pieces that long deletions reach into (1 and up), then reads (`more` null) in order of start and read_id. And whether there is
    more than one part of any piece. Parts are ranges of the order of start and read_id, numbered in that order. Counts need neither the
    letters of deletions nor an order of reads, nor names and qualities; their parts are dealt by hashes."""
    reads = _mapped(align).where(F.col("start").isNotNull() & F.col("cigar").isNotNull())
    home = F.floor((F.col("start") - 1) / PIECE)
    begun = reads.groupBy("chrom", home.alias("_home")).agg(F.count(F.lit(1)).alias("_n"), (F.lit(0) if counted else F.max(_deletion())).alias("_d"))
    most, longest = (x or 0 for x in begun.agg(F.max("_n"), F.max("_d")).first())
    part = F.lit(0)
    if most > DEEP:
        reads, deep = reads.withColumn("_home", home), F.broadcast(begun.where(F.col("_n") > DEEP).drop("_d"))
        if counted:
            reads = reads.join(deep, ["chrom", "_home"], "left")
            part = F.when(F.col("_n").isNull(), 0).otherwise(F.pmod(F.xxhash64("read_id"), F.ceil(F.col("_n") / DEEP)))
        else:
            reads = reads.join(F.broadcast(_bounds(reads, begun, deep)), ["chrom", "_home"], "left")
            inside = _upto(F.col("_ends"), F.col("_steps"), F.struct("start", "read_id"))
            part = F.coalesce(F.col("_before") + F.coalesce(inside, F.lit(0)), F.lit(0))
    last = F.floor((F.col("start") + reference_length(F.col("cigar")) - 2) / PIECE)
    fields = [F.col("start").cast("long").alias("start"), "fwd", "cigar", "seq"]
    if not counted:
        fields += ["read_id", F.col("mapq").cast("int").alias("mapq"), F.col("quals").cast("array<int>").alias("quals")]
    rows = reads.select("chrom", F.explode(F.sequence(home, F.greatest(home, last))).alias("piece"), part.cast("int").alias("part"), F.lit(None).cast("int").alias("more"), *fields)
    # A deletion's letters may lie behind the piece of the base before it.
    beyond = longest > PIECE
    pieces = _pieces(genome) if beyond else _pieces(genome, longest).drop("copy")
    found = pieces.withColumns({"part": F.lit(0), "more": F.lit(0)})
    if most > DEEP:
        parts = rows.where("part > 0").select("chrom", "piece", "part").distinct()
        found = found.unionByName(pieces.join(parts, ["chrom", "piece"]).withColumn("more", F.lit(0)))
    if beyond:
        reach = F.explode(F.sequence(F.lit(1), F.ceil(_deletion() / PIECE).cast("int"))).alias("more")
        needed = rows.where(F.col("cigar").contains("D")).select("chrom", F.col("piece").alias("_at"), "part", reach).distinct()
        needed = needed.withColumn("piece", F.col("_at") + F.col("more"))
        found = found.unionByName(pieces.join(needed, ["chrom", "piece"]).drop("piece").withColumnRenamed("_at", "piece"))
    group = ["chrom", "piece", "part"]
    both = rows.unionByName(found, allowMissingColumns=True)
    order = [] if counted else ["start", "read_id", "cigar", "seq", "fwd"]
    return both.repartition(*group).sortWithinPartitions(*group, F.col("more").asc_nulls_last(), *order), most > DEEP


def _qualities(lists: pa.Array) -> list[str]:
    """A string of Phred+33 letters for each list; nulls count as zero, and no list as an empty one."""
    flat = pc.fill_null(lists.flatten(), 0).to_numpy(zero_copy_only=False)
    text = (np.clip(flat, -33, 93) + 33).astype(np.uint8).tobytes().decode("latin-1")
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)).tolist()
    return [text[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def _texts(begin: int, cigar: str, seq: str, quals: str, fwd: bool, mapq: int | None, ref: str, low: int, high: int) -> tuple[int, list[str], str]:
    """First place, texts and qualities of what a read adds to the places from low to high (0-based, open)."""
    at, q, first, texts, marks = begin, 0, None, [], []
    case = str.upper if fwd else str.lower
    for n, op in _OPERATION.findall(cigar):
        n = int(n)
        if op in "HP" or not n:
            continue
        told = bool(texts) and at <= high  # the base before this operation is the last one in texts
        if op == "S":
            q += n
            continue
        if op == "I":
            if told:
                texts[-1] += f"+{n}{case(seq[q : q + n])}"
            q += n
            continue
        a, b = max(at, low), min(at + n, high)
        if op == "D" and told:
            texts[-1] += f"-{n}{case(ref[at - low : at - low + n].ljust(n, 'N'))}"
        if a < b and first is None:
            first = a
        if op in "DN":
            if a < b:
                texts += ["*" if op == "D" else "><"[not fwd]] * (b - a)
                # A base of a deletion has the quality of the next base of the read, or of the last one.
                marks.append((quals[min(q, len(quals) - 1)] if quals else "!") * (b - a))
        else:
            if a < b:
                k = q + a - at
                own, want, same = seq[k : k + b - a], ref[a - low : b - low].ljust(b - a, "N"), ".," [not fwd]
                if own.upper() == want.upper():
                    texts += [same] * (b - a)
                else:
                    texts += [same if x.upper() == y.upper() else case(x) for x, y in zip(own, want, strict=False)] + [""] * (b - a - len(own))
                marks.append(quals[k : k + b - a].ljust(b - a, "!"))
            q += n
        at += n
    if texts:
        if first == begin:
            mark = min(93 if mapq is None else mapq, 93) + 33
            texts[0] = f"^{chr(mark % 256) if mark >= 0 else ''}{texts[0]}"
        if at <= high:
            texts[-1] += "$"
    return first or 0, texts, "".join(marks)


def _points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of all texts, one after the other, and where each begins, with the end of the last one."""
    return np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64), np.cumsum([0, *map(len, texts)])


def _characters(points: np.ndarray) -> pa.Array:
    """The letter of each code point."""
    seen = np.zeros(points.max(initial=0) + 1, bool)
    seen[points] = True
    return pa.array(list(map(chr, np.flatnonzero(seen).tolist())), pa.string()).take(pa.array((np.cumsum(seen) - 1)[points]))


def _added(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, and the sum of n of each."""
    order = np.argsort(codes, kind="stable")
    codes, n = codes[order], n[order]
    first = np.flatnonzero(np.diff(codes, prepend=codes[:1] - 1))
    return codes[first], np.add.reduceat(n, first) if len(first) else n


def _runs(cigars: list[str], begin: np.ndarray, low: np.ndarray, high: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of aligned letters and of deletions on the places of reads from low to high (0-based, open): the read, the first place,
    how many, and where they begin in the read (-1 for a deletion). sizes: letters of the reads."""
    points, starts = _points(cigars)
    end = np.flatnonzero((points < ord("0")) | (points > ord("9")))
    read = np.searchsorted(starts, end, "right") - 1
    digits = end - np.maximum(np.append(0, end + 1)[:-1], starts[read])
    n = np.zeros(len(end), np.int64)
    for d in range(digits.max(initial=0)):
        some = digits > d
        n[some] += (points[end[some] - 1 - d] - ord("0")) * 10**d
    head, is_any = np.searchsorted(read, read), lambda kinds: np.isin(points[end], list(map(ord, kinds)))

    def before(steps: np.ndarray) -> np.ndarray:
        total = np.cumsum(steps) - steps
        return total - total[head]

    at, q, gone = begin[read] + before(n * is_any("MDN=X")), before(n * is_any("MIS=X")), is_any("D")
    a, b = np.maximum(at, low[read]), np.minimum(at + n, high[read])
    b = np.where(gone, b, np.minimum(b, at + sizes[read] - q))
    hit = is_any("M=XD") & (a < b)
    return read[hit], a[hit], (b - a)[hit], np.where(gone, -1, q + a - at)[hit]


def _count_pass(piece_size: int, held_most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass over groups of _beside to rows of COUNT. A count's code is its group in the batch, place in the piece, strand and base;
    of the group that the next batch may go on with, counts are kept, at most as many as a piece has places, strands and bases."""
    names = [x.split()[0] for x in COUNT.split(", ")]
    stride = piece_size * 2 * _POINTS

    def rows(keys: list[tuple], refs: list[list[str]], codes: np.ndarray, n: np.ndarray) -> Iterator[pa.RecordBatch]:
        for x in range(0, len(codes), ROWS):
            part, m = codes[x : x + ROWS], n[x : x + ROWS]
            group, low = part // stride, part[0] // stride
            here = [r or [""] for r in refs[low : group[-1] + 1]]
            # A row for each letter of the reference, where it lists a sequence more than once.
            times = np.array(list(map(len, here)))
            upto, times = np.cumsum(times), times[group - low]
            line = np.repeat(np.arange(len(part)), times)
            ref = (upto[group - low] - 1)[line] - (np.cumsum(times)[line] - 1 - np.arange(len(line)))
            points, starts = _points([*(s for r in here for s in r), "N"])
            k = (part // (2 * _POINTS) % piece_size)[line]
            letter = points[np.where(k < np.diff(starts)[ref], starts[ref] + k, len(points) - 1)]
            if len(line) > len(part):
                both, m = _added(line * _POINTS + letter, m[line])
                line, letter = both // _POINTS, both % _POINTS
            part, group = part[line], group[line]
            own = keys[low : group[-1] + 1]
            pos = np.array([p for _, p, _ in own])[group - low] * piece_size + part // (2 * _POINTS) % piece_size + 1
            chrom, strand = pa.array([c for c, _, _ in own], pa.string()).take(pa.array(group - low)), pa.array(["-", "+"]).take(pa.array(part // _POINTS % 2))
            yield pa.RecordBatch.from_arrays([chrom, pa.array(pos), _characters(letter), strand, _characters(part % _POINTS), pa.array(m)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, refs = [], []
        codes = n = np.zeros(0, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            chrom, piece, part = batch.column("chrom"), batch.column("piece").to_numpy(), batch.column("part").to_numpy()
            names_of = chrom.dictionary_encode(null_encoding="encode").indices.to_numpy(zero_copy_only=False)
            new = np.append(True, (np.diff(names_of) != 0) | (np.diff(piece) != 0) | (np.diff(part) != 0))
            at = np.flatnonzero(new)
            found = list(zip(chrom.take(pa.array(at)).to_pylist(), piece[at].tolist(), part[at].tolist(), strict=True))
            known = len(keys) - (keys == found[:1])  # 1 if a group is left that these rows do not go on with
            group = np.cumsum(new) - 1 + known
            keys, refs = keys[:known] + found, refs + [[] for _ in range(known + len(found) - len(refs))]
            texts, cigars, is_ref = batch.column("seq").to_pylist(), batch.column("cigar").to_pylist(), batch.column("more").is_valid().to_numpy(zero_copy_only=False)
            for i in np.flatnonzero(is_ref).tolist():
                refs[group[i]].append(texts[i])
            read = np.flatnonzero(~is_ref)
            points, starts = _points([*((texts[i] or "").upper() for i in read.tolist()), "-"])
            begin, low = pc.fill_null(batch.column("start"), 1).to_numpy()[read] - 1, piece[read] * piece_size
            fwd = pc.fill_null(batch.column("fwd"), False).to_numpy(zero_copy_only=False)[read]
            of, first, size, q = _runs([cigars[i] for i in read.tolist()], begin, low, low + piece_size, np.diff(starts)[:-1])
            spot = ((group[read][of] * piece_size + first - low[of]) * 2 + fwd[of]) * _POINTS
            source, step, upto = np.where(q < 0, len(points) - 1, starts[of] + q), (q >= 0).astype(np.int64), np.cumsum(size)
            edges = np.flatnonzero(np.diff((upto - 1) // held_most, prepend=-1, append=-1)) if len(of) else []
            for x, y in zip(edges[:-1], edges[1:], strict=True):
                times = size[x:y]
                run_of = np.repeat(np.arange(x, y), times)
                along = np.arange(len(run_of)) - np.repeat(np.cumsum(times) - times, times)
                more = np.unique(spot[run_of] + along * 2 * _POINTS + points[source[run_of] + along * step[run_of]], return_counts=True)
                codes, n = _added(np.concatenate([codes, more[0]]), np.concatenate([n, more[1]]))
                done = np.searchsorted(codes, group[read][of[y - 1]] * stride)
                yield from rows(keys, refs, codes[:done], n[:done])
                codes, n = codes[done:], n[done:]
            last = len(keys) - 1
            done = np.searchsorted(codes, last * stride)
            yield from rows(keys, refs, codes[:done], n[:done])
            codes, n, keys, refs = codes[done:] - last * stride, n[done:], keys[last:], refs[last:]
        yield from rows(keys, refs, codes, n)

    return run


def _pass(piece_size: int, held_most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One pass over groups of _beside to rows of COLUMN."""
    names = [x.split()[0] for x in COLUMN.split(", ")]
    kinds = {"pos": pa.int64(), "part": pa.int32(), "depth": pa.int32()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[tuple] = []
        key, refs, reach, cells, held, letters = None, [], [], {}, 0, 0

        def rows() -> pa.RecordBatch:
            columns = zip(*out, strict=True) if out else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, kinds.get(x, pa.string())) for x, c in zip(names, columns, strict=True)], names=names)

        def done(until: int | None) -> Iterator[pa.RecordBatch]:
            """Rows of the places below `until`, which no later read reaches."""
            nonlocal letters
            for at in sorted(cells if until is None else [p for p in cells if p < until]):
                cell, k = cells.pop(at), at - key[1] * piece_size
                ref = max((r[k : k + 1] or "N" for r in refs), default="N")
                out.append((key[0], at + 1, ref, key[2], len(cell[1]), "".join(cell[0]), "".join(cell[1])))
                letters += 3 * len(cell[1])
                if len(out) >= ROWS or letters > LETTERS:
                    yield rows()
                    out.clear()
                    letters = 0

        for batch in batches:
            get = lambda name: batch.column(name).to_pylist()  # noqa: E731, B023
            groups = zip(get("chrom"), get("piece"), get("part"), strict=True)
            quals = _qualities(batch.column("quals"))
            copies = get("copy") if "copy" in batch.schema.names else [None] * batch.num_rows
            for group, more, copy, start, fwd, cigar, seq, q, quality in zip(groups, get("more"), copies, get("start"), get("fwd"), get("cigar"), get("seq"), get("mapq"), quals, strict=True):
                if group != key:
                    yield from done(None)
                    key, refs, reach, held = group, [], [], 0
                    low, high = key[1] * piece_size, key[1] * piece_size + piece_size
                if more is not None:
                    if more == 0:
                        refs.append(seq)
                        reach.append((copy, 0))
                    else:
                        r = reach.index((copy, more - 1))
                        refs[r], reach[r] = refs[r] + seq, (copy, more)
                    continue
                if reach:
                    refs.sort()
                    reach.clear()
                if held > held_most:
                    yield from done(start - 1)
                    held = 0
                for ref in refs or [""]:
                    first, texts, marks = _texts(start - 1, cigar, seq or "", quality, fwd, q, ref, low, high)
                    held += len(texts)
                    for p, (text, mark) in enumerate(zip(texts, marks, strict=True), first):
                        cell = cells.get(p)
                        if cell is None:
                            cells[p] = [text], [mark]
                        else:
                            cell[0].append(text)
                            cell[1].append(mark)
        yield from done(None)
        yield rows()

    return run


def pileup(align: DataFrame, genome: DataFrame) -> DataFrame:
    """chrom, pos, ref, depth, bases, quals of every covered position, as samtools mpileup writes them without base alignment qualities,
    and with reads of any depth and quality.

    Unmapped reads and those without a CIGAR string are left out; reads stand in order of start and read_id. Positions beyond
    the reference, and sequences that it lacks, have the reference N. genome: seqid, seq.

    Reads that begin in a piece of the reference where more than DEEP do are dealt to parts, so that no group holds many more reads
    before strings are made of them. Parts are ranges of the order of reads and are joined in that order, so results are the same
    with any number of parts. How many begin in each piece is counted, and where ranges begin is found, when the plan is made.
    """
    rows, parts = _beside(align, genome)
    texts = rows.mapInArrow(_pass(PIECE, HELD), COLUMN)
    if not parts:
        return texts.drop("part")
    whole = texts.groupBy("chrom", "pos").agg(F.max("ref").alias("ref"), F.sum("depth").cast("int").alias("depth"), F.sort_array(F.collect_list(F.struct("part", "bases", "quals"))).alias("p"))
    return whole.select("chrom", "pos", "ref", "depth", F.concat_ws("", "p.bases").alias("bases"), F.concat_ws("", "p.quals").alias("quals"))


def position_counts(align: DataFrame, genome: DataFrame) -> DataFrame:
    """chrom, pos, ref, strand, base, n: reads with a base (or - for a deletion) at each position, without a list of them: counts
    are added up in one pass over the reads of a piece, or of its parts, so depth does not matter."""
    rows, parts = _beside(align, genome, counted=True)
    n = rows.mapInArrow(_count_pass(PIECE, HELD), COUNT)
    return n.groupBy("chrom", "pos", "ref", "strand", "base").agg(F.sum("n").alias("n")) if parts else n


def write_sorted(align: DataFrame, path: str, partitions: int, rows_per_group: int = 100_000) -> None:
    """Alignments in order of sequence and start, as Parquet that regions can be read from: files hold ranges that do not overlap, and
    each carries `end_pos`; unmapped reads (null chrom or start) come last. A third of all reads at one place still spreads: read_id ends the order."""
    order = [F.col("chrom").asc_nulls_last(), F.col("start").asc_nulls_last(), F.col("read_id").asc()]
    known = align.withColumn("end_pos", F.col("start") + reference_length(F.col("cigar")) - 1)
    known.repartitionByRange(partitions, *order).sortWithinPartitions(*order).write.option("parquet.block.row.count.limit", rows_per_group).mode("overwrite").parquet(path)


def read_region(spark: SparkSession, path: str, chrom: str, begin: int, end: int, longest: int | None = None) -> DataFrame:
    """Alignments of a sorted table that cover any position in begin..end. Bounds of the columns prune files and row groups:
    on chrom and end_pos, and on start; `longest`, the longest reference length if known, adds a lower bound on start."""
    here = (F.col("chrom") == chrom) & (F.col("start") <= end) & (F.col("end_pos") >= begin)
    return spark.read.parquet(path).where(here & (F.col("start") > begin - longest) if longest else here)
