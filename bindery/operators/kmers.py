"""k-mer counts, frequencies, positions and log odds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructField, StructType

from bindery.functions.sequences import BASES, chunks, kmers, revcomp
from bindery.operators.lineage import cut as cut_lineage

#: Letters in a piece of a sequence.
CHUNK = 10_000
#: The largest k whose 4^k counts are kept in an array, and letters that are counted at once.
DENSE, LETTERS = 8, 250_000
#: The clamp of log odds for plots, by k.
CLAMP = {2: 2.5, 3: 2.5, 4: 3.0, 5: 4.0, 6: 4.0}


def _name(i: Column, k: int) -> Column:
    """The k-mer over ACGT at place i (from 0) of the alphabet's order."""
    return F.concat(*[F.substring(F.lit("".join(BASES)), (F.shiftright(i, 2 * j).bitwiseAND(3) + 1).cast("int"), F.lit(1)) for j in reversed(range(k))])


def universe(spark: SparkSession, k: int) -> DataFrame:
    """All 4^k k-mers over ACGT."""
    return spark.range(4**k).select(_name(F.col("id"), k).alias("kmer"))


def cut(seqs: DataFrame, k: int, width: int = CHUNK) -> DataFrame:
    """seqs with `seq` in pieces of `width` letters and the k - 1 after them, and `begin`, the place (from 0) of a piece.

    So a sequence of any length is worked on in rows of bounded size, and every k-mer is seen once."""
    rest = [c for c in seqs.columns if c != "seq"]
    return seqs.select(*rest, F.posexplode(chunks(F.col("seq"), width, k - 1)).alias("begin", "seq")).withColumn("begin", F.col("begin").cast("long") * width)


def _codes(letters: np.ndarray, k: int) -> np.ndarray:
    """The place in the universe of the k-mer that begins at each letter; 4^k if it holds a letter outside ACGT."""
    code = np.full(256, 4**k, np.int32)
    code[np.frombuffer("".join(BASES).encode(), np.uint8)] = range(len(BASES))
    of = code[letters]
    places = max(len(of) - k + 1, 0)
    kmer = of[:places].copy()
    for j in range(1, k):
        kmer *= 4
        kmer += of[j : j + places]
    return np.minimum(kmer, 4**k, out=kmer)


def _tally(k: int, by: str | None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts (_n) of the k-mers over ACGT in each batch of sequences, and of each value of `by`; no row is made for a letter."""
    names = np.array(["".join(BASES[i >> 2 * j & 3] for j in reversed(range(k))) for i in range(4**k)], object)
    wide = 4**k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(by).dictionary_encode(null_encoding="encode") if by else None
            group = keys.indices.to_numpy(zero_copy_only=False) if by else np.zeros(batch.num_rows, np.int64)
            # A line end after each sequence, which no k-mer crosses.
            texts = [b"%b\n" % (s or b"") for s in batch.column("seq").cast(pa.binary()).to_pylist()]
            letters, owner = np.frombuffer(b"".join(texts), np.uint8), np.repeat(group.astype(np.int64) * wide, [len(s) for s in texts])
            n = np.zeros((len(keys.dictionary) if by else 1) * wide, np.int64)
            for at in range(0, len(letters) - k + 1, LETTERS):
                kmer = _codes(letters[at : at + LETTERS + k - 1], k)
                n += np.bincount(owner[at : at + len(kmer)] + kmer, minlength=len(n))
            n = n.reshape(-1, wide)[:, :-1].ravel()
            hit = np.flatnonzero(n)
            of = [keys.dictionary.take(pa.array(hit // 4**k))] if by else []
            yield pa.RecordBatch.from_arrays([*of, pa.array(names[hit % 4**k], pa.string()), pa.array(n[hit])], names=[*([by] if by else []), "kmer", "_n"])

    return run


def _counts(k: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Each batch with the number of letters of a text and its 4^k counts in place of it."""
    upper, others = bytes.maketrans(b"acgt", b"ACGT"), bytes(set(range(256)) - set(b"ACGTacgt"))
    wide = 4**k + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [None if s is None else s.translate(upper, others) for s in batch.column("text").cast(pa.binary()).to_pylist()]
            # A line end after each sequence, which no k-mer crosses.
            letters = np.frombuffer(b"".join(b"%b\n" % (s or b"") for s in texts), np.uint8)
            ends = np.cumsum([len(s or b"") + 1 for s in texts])
            out = np.zeros((len(texts), 4**k), np.int32)
            for at in range(0, len(letters) - k + 1, LETTERS):
                kmer = _codes(letters[at : at + LETTERS + k - 1], k)
                first, last = np.searchsorted(ends, [at, at + len(kmer) - 1], "right")
                sizes = np.diff(np.minimum(ends[first : last + 1], at + len(kmer)), prepend=at)
                owner = np.repeat(np.arange(len(sizes)) * wide, sizes)
                out[first : last + 1] += np.bincount(owner + kmer, minlength=len(sizes) * wide).reshape(-1, wide)[:, :-1].astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1, dtype=np.int32) * 4**k), pa.array(out.ravel()))
            rest = [c for c in batch.schema.names if c != "text"]
            sizes = pa.array([None if s is None else len(s) for s in texts], pa.int32())
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in rest], sizes, lists], names=[*rest, "letters", "counts"])

    return run


def spectra(texts: DataFrame, k: int) -> DataFrame:
    """texts with two columns in place of `text`: `letters`, how many letters ACGT of either case it has, null for a null
    text, and `counts`, how often each k-mer over these letters, in the alphabet's order, occurs. What lies between
    letters is left out first. For short k: a row holds 4^k counts."""
    kinds = [StructField(f.name, f.dataType) for f in texts.schema if f.name != "text"]
    return texts.mapInArrow(_counts(k), StructType([*kinds, StructField("letters", IntegerType()), StructField("counts", ArrayType(IntegerType()))]))


def summed(counted: DataFrame, k: int, by: str | None = None) -> DataFrame:
    """(`by`,) kmer, n, zero ones too, of rows with `counts`; nothing is made a row before it is summed."""
    key = [by] if by else []
    sums = counted.groupBy(*key).agg(*[F.sum(F.col("counts")[i]).alias(f"_{i}") for i in range(4**k)])
    each = sums.select(*key, F.posexplode(F.array(*[f"_{i}" for i in range(4**k)])).alias("_i", "n"))
    return each.select(*key, _name(F.col("_i"), k).alias("kmer"), F.coalesce("n", F.lit(0)).alias("n"))


def _counted(seqs: DataFrame, k: int, by: str | None = None) -> DataFrame:
    """(`by`,) kmer, n of the k-mers over ACGT; k-mers with other letters are left out."""
    key = [by] if by else []
    pieces = cut(seqs.select(*key, "seq"), k)
    if k > DENSE:
        known = pieces.select(*key, F.explode(kmers(F.col("seq"), k)).alias("kmer")).where(~F.col("kmer").rlike("[^ACGT]"))
        return known.groupBy(*key, "kmer").agg(F.count(F.lit(1)).alias("n"))
    kinds = [f"`{by}` {seqs.schema[by].dataType.simpleString()}"] if by else []
    found = pieces.select(*key, "seq").mapInArrow(_tally(k, by), ", ".join([*kinds, "kmer string, _n bigint"]))
    return found.groupBy(*key, "kmer").agg(F.sum("_n").alias("n"))


def count(seqs: DataFrame, k: int, pseudo: int = 0) -> DataFrame:
    """kmer, n over all sequences; with a pseudocount every k-mer of the universe appears. k-mers with other letters are left out."""
    found = _counted(seqs, k)
    if not pseudo:
        return found
    return universe(seqs.sparkSession, k).join(found, "kmer", "left").select("kmer", (F.coalesce("n", F.lit(0)) + pseudo).alias("n"))


def frequencies(counts: DataFrame) -> DataFrame:
    """kmer, freq. Counts are used twice, for the total too, and so are taken from a checkpoint: sequences are read once."""
    counts = cut_lineage(counts)
    total = counts.agg(F.sum("n").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("kmer", (F.col("n") / F.col("total")).alias("freq"))


def by_position(seqs: DataFrame, k: int, dense: bool = False, width: int = 0) -> DataFrame:
    """kmer, pos (0-based), n; dense adds zeros for every k-mer and position below `width`."""
    at = cut(seqs.select("seq"), k).select("begin", F.posexplode(kmers(F.col("seq"), k)).alias("pos", "kmer"))
    found = at.groupBy("kmer", (F.col("begin") + F.col("pos")).cast("int").alias("pos")).agg(F.count(F.lit(1)).alias("n"))
    if not dense:
        return found
    grid = universe(seqs.sparkSession, k).crossJoin(F.broadcast(seqs.sparkSession.range(width).select(F.col("id").cast("int").alias("pos"))))
    return grid.join(found, ["kmer", "pos"], "left").select("kmer", "pos", F.coalesce("n", F.lit(0)).alias("n"))


def top(counts: DataFrame, n: int = 10) -> DataFrame:
    """k-mers with the largest count at any position."""
    return counts.groupBy("kmer").agg(F.max("n").alias("peak")).orderBy(F.col("peak").desc(), "kmer").limit(n)


def log_odds(seqs: DataFrame, background: DataFrame, k: int, clamp: float | None = None) -> DataFrame:
    """bin, kmer, log_odds: log2 of the share of a k-mer in a bin (pseudocount 1) by its background frequency.

    seqs: bin, seq. background: kmer, freq. Both tables of k-mers have 4^k rows."""
    found = _counted(seqs, k, "bin")
    grid = seqs.select("bin").distinct().crossJoin(F.broadcast(background))
    return odds_of(grid.join(found, ["bin", "kmer"], "left").withColumn("n", F.coalesce("n", F.lit(0))), clamp)


def odds_of(full: DataFrame, clamp: float | None = None) -> DataFrame:
    """bin, kmer, log_odds of all bins and k-mers with their count n and background freq."""
    full = full.withColumn("n", F.col("n") + 1)
    # The total of a bin by a window: grouped and joined back, all k-mers would be counted once more.
    odds = F.log2((F.col("n") / F.sum("n").over(Window.partitionBy("bin"))) / F.col("freq"))
    if clamp is not None:
        odds = F.greatest(F.least(odds, F.lit(clamp)), F.lit(-clamp))
    return full.select("bin", "kmer", odds.alias("log_odds"))


def leading(odds: DataFrame, bins: int = 3) -> DataFrame:
    """k-mers by the sum of their log odds over the first bins."""
    return odds.where(F.col("bin") < bins).groupBy("kmer").agg(F.sum("log_odds").alias("lead")).orderBy(F.col("lead").desc(), "kmer")


def information(seqs: DataFrame, width: int) -> DataFrame:
    """pos, ic: 2 + sum p log2 p over ACGT at each position."""
    at = seqs.where(F.length("seq") >= width).select(F.posexplode(F.split(F.substring("seq", 1, width), "")).alias("pos", "base")).where(F.col("base").isin(*BASES))
    n = at.groupBy("pos", "base").agg(F.count(F.lit(1)).alias("n"))
    total = n.groupBy("pos").agg(F.sum("n").alias("total"))
    p = F.col("n") / F.col("total")
    return n.join(F.broadcast(total), "pos").groupBy("pos").agg((2 + F.sum(p * F.log2(p))).alias("ic"))


def windows(sites: DataFrame, genome: DataFrame, width: int, keep: bool = False, chunk: int = CHUNK) -> DataFrame:
    """Sites with `seq`, the strand's sequence from width before to width after; out-of-range sites are dropped, or
    with `keep` stay with a null seq.

    genome: seqid, seq. Sequences are cut into pieces that hold a whole window, and sites join the piece that
    theirs begins in, so that no sequence is copied for each of its sites."""
    pieces = genome.select("seqid", F.posexplode(chunks(F.col("seq"), chunk, 2 * width)).alias("_piece", "_seq"))
    first = F.col("position") - width - 1
    placed = sites.withColumn("_piece", F.when(first >= 0, F.floor(first / chunk)).cast("int"))
    joined = placed.join(pieces, ["seqid", "_piece"], "left" if keep else "inner")
    seq = F.substring(F.col("_seq"), (first - F.col("_piece").cast("long") * chunk + 1).cast("int"), F.lit(2 * width + 1))
    seq = F.when(F.length(seq) == 2 * width + 1, F.when(F.col("strand") == "-", revcomp(seq)).otherwise(seq))
    out = joined.withColumn("seq", seq).drop("_piece", "_seq")
    return out if keep else out.where(F.col("seq").isNotNull())


def rank_bins(ranked: DataFrame, size: int = 1000, most: int = 50_000) -> DataFrame:
    """Rows (`rank`, from 0) with `bin`: groups of `size` ranks up to rank `most`; a bin that ends beyond the last rank
    but one is left out, and so are its rows."""
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    end = (F.floor(F.col("rank") / size) + 1) * size
    return ranked.crossJoin(F.broadcast(n)).where((end <= most) & (end <= F.col("_n") - 2)).withColumn("bin", F.floor(F.col("rank") / size)).drop("_n")


def centred_bins(ranked: DataFrame, quantiles: list[float], half: int = 500) -> DataFrame:
    """Rows with each `bin` that holds their rank: bin 0 the first 2 * half ranks, then `half` ranks to either side of
    each quantile; bins may overlap."""
    n = ranked.agg(F.count(F.lit(1)).alias("_n"))
    spans = [F.struct(F.lit(0).alias("bin"), F.lit(0).cast("long").alias("low"), F.lit(2 * half).cast("long").alias("high"))]
    for i, q in enumerate(quantiles, 1):
        mid = F.floor(F.col("_n") * q)
        spans.append(F.struct(F.lit(i).alias("bin"), (mid - half).alias("low"), (mid + half).alias("high")))
    hit = F.filter(F.array(*spans), lambda b: (F.col("rank") >= b["low"]) & (F.col("rank") <= b["high"]))
    return ranked.crossJoin(F.broadcast(n)).withColumn("bin", F.explode(F.transform(hit, lambda b: b["bin"]))).drop("_n")


def quartiles(counts: DataFrame, parts: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:
    """pos and a quartile of the counts of all k-mers at each position, the baselines of the position plot."""
    return counts.groupBy("pos").agg(*[F.expr(f"percentile(n, {q}D)").alias(f"q{round(100 * q)}") for q in parts])


def reverse_pwm(pwm: DataFrame, width: int) -> DataFrame:
    """A matrix (pos from 0, base, p) read on the other strand: positions reversed, bases complemented."""
    return pwm.select((F.lit(width - 1) - F.col("pos")).alias("pos"), F.translate("base", "ACGT", "TGCA").alias("base"), "p")
