"""Read ends: adapters found with errors, and bases of low quality trimmed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows of a batch that are matched in step.
ROWS = 4096
ONE = np.uint64(1)


def _rows(texts: list[bytes], reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Texts as rows of letters, padded with zeros, and their lengths."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    out = np.zeros((len(texts), int(size.max(initial=0))), np.uint8)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer(b"".join(t[::-1] for t in texts) if reverse else b"".join(texts), np.uint8)
    return out, size


def _distances(pattern: bytes, letters: np.ndarray, size: np.ndarray, free: bool) -> tuple[np.ndarray, np.ndarray]:
    """Edit distances of a pattern of at most 63 letters, for all texts in step, by Myers' bit vectors.

    First for each end in the text (0 to its length) the distance of the whole pattern to what ends there, begun anywhere with
    `free`, else at the start; then for each prefix of the pattern the distance at the end of the text. Past the end: large."""
    n, m = letters.shape[0], len(pattern)
    table = np.zeros(256, np.uint64)
    for k, c in enumerate(pattern):
        table[c] |= ONE << np.uint64(k)
    table[ord("N")] = 0
    mask, high = np.uint64((1 << m) - 1), np.uint64(m - 1)
    up, down = np.full(n, mask), np.zeros(n, np.uint64)
    score = np.full(n, m, np.int64)
    ends = np.full((n, letters.shape[1] + 1), 1 << 20, np.int64)
    ends[:, 0] = m
    for j in range(letters.shape[1]):
        live = j < size
        equal = table[letters[:, j]]
        across = (((equal & up) + up) ^ up) | equal
        plus, minus = down | ~(across | up), up & across
        added = ((plus >> high) & ONE).astype(np.int64) - ((minus >> high) & ONE).astype(np.int64)
        plus, minus = (plus << ONE) | np.uint64(0 if free else 1), minus << ONE
        vertical = equal | down
        new_up, new_down = (minus | ~(vertical | plus)) & mask, plus & vertical & mask
        score = np.where(live, score + added, score)
        up, down = np.where(live, new_up, up), np.where(live, new_down, down)
        ends[live, j + 1] = score[live]
    bit = np.arange(m, dtype=np.uint64)
    step = ((up[:, None] >> bit) & ONE).astype(np.int64) - ((down[:, None] >> bit) & ONE).astype(np.int64)
    return ends, (np.zeros(n, np.int64) if free else size)[:, None] + np.cumsum(step, axis=1)


def find_adapter(texts: list[bytes], adapter: bytes, rate: float, overlap: int) -> np.ndarray:
    """Where the adapter begins in each text, the text's length if nowhere; see `clip_tolerant`."""
    m, n = len(adapter), len(texts)
    backward, size = _rows(texts, reverse=True)
    # Backwards, an end is the place where the adapter begins.
    whole = _distances(adapter[::-1], backward, size, True)[0]
    least = whole.min(axis=1)
    # The last end backwards is the leftmost place.
    place = size - (whole.shape[1] - 1 - np.argmin(whole[:, ::-1], axis=1))
    good = least <= int(rate * m + 1e-9)
    gain, edits, where = np.where(good, m - least, -1), np.where(good, least, 0), np.where(good, place, size)
    if m > 1:
        tails = _distances(adapter, _rows(texts)[0], size, True)[1][:, : m - 1]
        p = np.arange(1, m)
        allowed = np.floor(rate * p + 1e-9).astype(np.int64)
        fits = (p >= overlap) & (tails <= allowed)
        # Most matched letters, then fewest edits: both as one number.
        value = np.where(fits, (p - tails) * (2 * m) - tails, -1 << 40)
        best = np.argmax(value, axis=1)
        mine = value[np.arange(n), best]
        better = mine > np.where(good, gain * (2 * m) - edits, -1 << 40)
        for k in np.unique(best[better]):
            rows = np.flatnonzero(better & (best == k))
            anchored = _distances(adapter[: k + 1][::-1], backward[rows], size[rows], False)[0]
            hit = anchored == tails[rows, k][:, None]
            where[rows] = size[rows] - (hit.shape[1] - 1 - np.argmax(hit[:, ::-1], axis=1))
    return where


def _clipper(adapter: str, rate: float, overlap: int, at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                texts = [(t or "").upper().encode("ascii", "replace") for t in part.column(at).to_pylist()]
                # Texts of like length share an array, so that one long read does not make all rows long.
                places = np.zeros(len(texts), np.int64)
                by: dict[int, list[int]] = {}
                for i, t in enumerate(texts):
                    by.setdefault(len(t).bit_length(), []).append(i)
                for rows in by.values():
                    places[rows] = find_adapter([texts[i] for i in rows], adapter.encode(), rate, overlap)
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(places, pa.int32())], names=[*part.schema.names, "_keep"])

    return run


def clip_tolerant(reads: DataFrame, adapter: str, rate: float = 0.1, overlap: int = 3, min_length: int = 0) -> DataFrame:
    """Reads cut where a 3' adapter begins that may have errors; qualities are cut alike, reads under `min_length` left out.

    Of the places where the whole adapter lies in the read with at most `rate` edits a letter, and those where at least
    `overlap` first letters of it end the read with as few for their number, that with the most matched letters (letters less
    edits) counts, then that with fewest edits, then the leftmost. An N matches nothing, case does not matter. A null read
    stays null, an empty one empty. Adapters have 1 to 63 letters."""
    if not 1 <= len(adapter) <= 63:
        raise ValueError("an adapter has 1 to 63 letters")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in reads.schema.fields) + ", _keep int"
    found = reads.mapInArrow(_clipper(adapter.upper(), rate, max(overlap, 1), reads.columns.index("seq")), schema)
    short = lambda c: F.substring(F.col(c), F.lit(1), F.col("_keep"))
    cuts = {c: short(c) for c in ("seq", "qual") if c in reads.columns}
    return found.withColumns(cuts).drop("_keep").where(F.length("seq") >= min_length if min_length else F.lit(True))


def phred(qual: Column, base: int = 33) -> Column:
    """Qualities of a quality string; an empty array for the empty string."""
    return F.transform(F.filter(F.split(qual, ""), lambda c: c != ""), lambda c: F.ascii(c) - base)


def trimmed_end(quals: Column, cutoff: int) -> Column:
    """How many letters stay if those of lower quality than `cutoff` are taken from the end, up to the first that is not."""
    return F.coalesce(F.array_max(F.transform(quals, lambda q, i: F.when(q >= cutoff, i + 1))), F.lit(0))


def trimmed_sum(quals: Column, cutoff: int) -> Column:
    """How many letters stay if the end is cut where the sum of (cutoff - quality) over what is cut is largest; the walk from the
    end stops where the sum falls below zero, and of equal sums the shortest cut counts. One fold over the reversed qualities."""
    zero = F.struct(F.lit(0).cast("long").alias("sum"), F.lit(0).cast("long").alias("best"), F.lit(0).alias("n"), F.lit(0).alias("cut"), F.lit(False).alias("done"))

    def step(a: Column, q: Column) -> Column:
        total = a["sum"] + cutoff - q
        done = a["done"] | (total < 0)
        more = ~done & (total > a["best"])
        return F.struct(total.alias("sum"), F.when(more, total).otherwise(a["best"]).alias("best"), (a["n"] + 1).alias("n"), F.when(more, a["n"] + 1).otherwise(a["cut"]).alias("cut"), done.alias("done"))

    return F.size(quals) - F.aggregate(F.reverse(quals), zero, step, lambda a: a["cut"])


def best_segment(quals: Column, cutoff: int) -> Column:
    """struct<begin, end>: the part of a read with the largest sum of (quality - cutoff), the leftmost and then the shortest of equal ones;
    0, 0 if no letter is above the cutoff. One fold that keeps the best sum that ends here."""
    names = ("sum", "begin", "n", "best", "from", "to")
    zero = F.struct(*[F.lit(0).cast("long").alias(x) for x in names])

    def step(a: Column, q: Column) -> Column:
        fresh = a["sum"] <= 0
        total = F.when(fresh, F.lit(0).cast("long")).otherwise(a["sum"]) + q - cutoff
        begin = F.when(fresh, a["n"]).otherwise(a["begin"])
        more = total > a["best"]
        return F.struct(total.alias("sum"), begin.alias("begin"), (a["n"] + 1).alias("n"), F.when(more, total).otherwise(a["best"]).alias("best"), F.when(more, begin).otherwise(a["from"]).alias("from"), F.when(more, a["n"] + 1).otherwise(a["to"]).alias("to"))

    return F.aggregate(quals, zero, step, lambda a: F.struct(a["from"].cast("int").alias("begin"), a["to"].cast("int").alias("end")))


def trim_quality(reads: DataFrame, cutoff: int = 30, min_length: int = 0, mode: str = "end", base: int = 33) -> DataFrame:
    """Reads (seq, qual) with letters of low quality trimmed, those under `min_length` left out. mode: `end`, `sum` or `segment`,
    as the functions above; empty reads stay empty, null ones null."""
    quals = phred(F.col("qual"), base)
    if mode == "segment":
        part = best_segment(quals, cutoff)
        begin, size = part["begin"] + 1, part["end"] - part["begin"]
    else:
        begin, size = F.lit(1), trimmed_end(quals, cutoff) if mode == "end" else trimmed_sum(quals, cutoff)
    cuts = {c: F.substring(F.col(c), begin.cast("int"), size.cast("int")) for c in ("seq", "qual")}
    return reads.withColumns(cuts).where(F.length("seq") >= min_length if min_length else F.lit(True))
