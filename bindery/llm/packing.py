"""Best-fit packing by bin completion.

Pieces of equal length are interchangeable, so the search runs on the histogram of piece lengths, which
has at most `capacity` rows however many documents there are. Bin completion takes the largest length
left, enumerates the fillings of the room beside it to which nothing can be added, leaves out those that another one
dominates (some of its pieces could give way to a single free one of at least their length), and branches on the others and
on how often each is repeated. Best-fit decreasing, first-fit decreasing and the least-waste fillings give the first
incumbent; a branch is cut when its waste so far already costs a bin more than the volume bound allows. Spark tokenises, counts, ranks the pieces of a
length in salted groups, and looks up each rank's place in the small table of fillings.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from bindery.llm.bpe import Merges
from bindery.llm.common import cut, per_worker, pieces_for, table

CAPACITY, END_ID = 4096, 1
FILLINGS, NODES = 64, 200_000
#: Words that a Python worker keeps encoded, and documents that it encodes at a time; both bound its memory.
MEMO, AT_A_TIME = 600_000, 1024
PIECES = "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, size bigint"


#: Words of these characters alone are left as they are by Unicode normalisation and cut by PARTS;
#: apostrophes (contractions), "<" (special tokens) and all else go to the library itself.
PLAIN = re.compile(r"[A-Za-z0-9\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff!-&(-/:;=-@\[-`{-~]+")
#: Letters, single digits and the rest of plain words in lower case, and the line feeds between words.
PARTS = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|\n|[^a-z0-9\n\u00df-\u00f6\u00f8-\u00ff]+")
#: Stands for a line feed among ids. Real ids have zero high bytes, so it is found nowhere else.
BETWEEN = b"\xff" * 4


class WordEncoder:
    """text -> little-endian 32-bit ids. The tokenizer drops white space and looks at nothing across it, so
    words between spaces or line feeds are encoded once and kept for the life of the Python worker."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_padding(), self.library.no_truncation()
        self.merges = Merges(path)
        self.memo: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _learn(self, new: list[str]) -> None:
        memo = self.memo
        plain = list(filter(PLAIN.fullmatch, new))
        if plain:
            # All words at once: their parts in one list, the ids of the parts in one string of bytes.
            flat = PARTS.findall("\n".join(plain).lower())
            wanted = set(flat)
            wanted.discard("\n")
            again = wanted & memo.keys()
            first = list(wanted - again)
            ids = dict(zip(first, self.merges.encode_words([p.encode() for p in first]), strict=True))
            ids.update((p, memo[p]) for p in again)
            ids["\n"] = BETWEEN
            memo.update(zip(plain, b"".join(map(ids.__getitem__, flat)).split(BETWEEN), strict=True))
        rest = list(set(new).difference(plain))
        memo.update((w, np.array(e.ids, dtype="<u4").tobytes()) for w, e in zip(rest, self.library.encode_batch_fast(rest, add_special_tokens=False), strict=True))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        split = [(t or "").replace("\n", " ").split(" ") for t in texts]
        seen = set().union(*split)
        new = seen.difference(self.memo)
        if len(self.memo) + len(new) > MEMO // 2:  # two halves: what the full one knows is taken over when it is met again
            self.old, self.memo = self.memo, {}
            new = seen
        again = new & self.old.keys()
        self.memo.update((w, self.old[w]) for w in again)
        new = new - again
        if new:
            self._learn(list(new))
        get = self.memo.__getitem__
        return [b"".join(map(get, w)) for w in split]


@per_worker
def encoder_of(path: str) -> WordEncoder:
    return WordEncoder(path)


def _pieces(tokenizer_path: str, capacity: int, end_id: int):
    end = np.uint32(end_id).astype("<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(tokenizer_path)
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64())
        names = [c.split()[0] for c in PIECES.split(", ")]
        for batch in batches:
            for s in range(0, max(1, batch.num_rows), AT_A_TIME):
                part = batch.slice(s, AT_A_TIME)
                rows = []
                for doc_id, ids in zip(part.column(0).to_pylist(), encoder.encode_all(part.column(1).to_pylist()), strict=True):
                    ids += end
                    for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        rows.append((doc_id, k, at // 4, len(piece) // 4, zlib.crc32(piece), len(ids) // 4))
                cols = list(zip(*rows, strict=True)) if rows else [()] * 6
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], names=names)

    return run


def fillings(room: int, lengths: list[int], counts: dict[int, int], most: int = FILLINGS) -> list[list[int]]:
    """Fillings of a room to which no piece left can be added, least waste first, found in 50 * `most` steps."""
    return _fillings(room, lengths, counts, 50 * most, True)[0][:most]


def _fillings(room: int, lengths: list[int], counts: dict[int, int], steps: int, first: bool) -> tuple[list[list[int]], bool, int]:
    """Fillings to which nothing can be added, least waste first; whether these are all; steps taken. Equal
    lengths are taken in one step. One piece that fits exactly dominates all else; with `first`, so does any
    filling without waste. The first one is found in less steps than there are different lengths in it."""
    if counts.get(room, 0):
        return [[room]], True, 1
    found: list[tuple[int, list[int]]] = []
    spent, whole = 0, True
    upto = bisect_right(lengths, room)
    volume = [0, *accumulate(x * counts[x] for x in lengths[:upto])] if not first else None

    def descend(left: int, k: int, taken: list[int], skipped: int) -> None:
        nonlocal spent, whole
        spent += 1
        k = min(k, bisect_right(lengths, left) - 1)
        while k >= 0:
            if spent >= steps and found:
                whole = False
                return
            if volume and left - volume[k + 1] >= skipped:
                return  # a piece passed over will fit whatever else is taken
            size = lengths[k]
            have = counts[size]
            fit = min(have, left // size)
            for n in range(fit, 0, -1):
                descend(left - n * size, k - 1, taken + [size] * n, size if n < have and size < skipped else skipped)
                if not whole or (first and found and found[-1][0] == 0):
                    return
            if fit and size < skipped:
                skipped = size
            k -= 1
        if left < skipped:
            found.append((left, taken))

    descend(room, upto - 1, [], room + 1)
    found.sort(key=lambda f: (f[0], len(f[1])))
    return [items for _, items in found], whole, spent


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[int, list[int]]]:
    """Bins of best-fit decreasing as (times, filling): each piece, the longest first, goes to the fullest bin that has room for it.

    Pieces of one length are placed together: the fullest bins with room for one take as many as fit before the next fuller ones do."""
    rooms: dict[int, list[tuple[int, list[int]]]] = {}
    order: list[int] = []  # the rooms that occur, ascending

    def put(room: int, times: int, items: list[int]) -> None:
        if times:
            if room not in rooms:
                insort(order, room)
            rooms.setdefault(room, []).append((times, items))

    for x in sorted(histogram, reverse=True):
        left = histogram[x]
        while left:
            k = bisect_left(order, x)
            if k < len(order):
                room = order[k]
                times, items = rooms[room].pop()
                if not rooms[room]:
                    del rooms[room], order[k]
            else:
                room, times, items = capacity, left, []
            each = room // x
            full = min(times, left // each)
            put(room - each * x, full, items + [x] * each)
            left -= full * each
            times -= full
            if times and left:  # fewer than a bin takes
                put(room - left * x, 1, items + [x] * left)
                left, times = 0, times - 1
            if items:
                put(room, times, items)
    return [b for room in order for b in rooms[room]]


def _smeared(bits: int, most: int) -> int:
    """Each bit, and the `most` places above it."""
    done = 1
    while done <= most:
        step = min(done, most + 1 - done)
        bits |= bits << step
        done += step
    return bits


def undominated(options: list[list[int]], room: int, counts: dict[int, int]) -> list[list[int]]:
    """The fillings of a room that no other dominates: there is no free length that could stand for two or more pieces of at most its
    length, or for a shorter piece, and still fit. Sums of pieces are bits of a number."""
    free = sum(1 << x for x, n in counts.items() if n > 0 and x <= room)
    kept = []
    for items in options:
        left = room - sum(items)
        some = several = ones = 0
        used: dict[int, int] = {}
        for x in items:
            several |= some << x
            some |= some << x | 1 << x
            ones |= 1 << x
            used[x] = used.get(x, 0) + 1
        other = free & ~sum(1 << x for x, n in used.items() if counts[x] <= n)
        better = _smeared(several, left) | (_smeared(ones << 1, left - 1) if left else 0)
        if not better & other:
            kept.append(items)
    return kept


def _greedy(histogram: dict[int, int], capacity: int, fit: bool) -> list[tuple[int, list[int]]]:
    """Bins as (times, filling). fit: the largest pieces that fit, bin by bin (first-fit decreasing); else the least-waste filling."""
    counts = dict(histogram)
    lengths = sorted(counts)
    out = []
    while lengths:
        big = lengths[-1]
        counts[big] -= 1
        if fit:
            items, room = [big], capacity - big
            while room and (k := bisect_right(lengths, room) - 1) >= 0:
                while k >= 0 and counts[lengths[k]] <= 0:
                    k -= 1
                if k < 0:
                    break
                counts[lengths[k]] -= 1
                items.append(lengths[k])
                room -= lengths[k]
            for x in items[1:]:
                counts[x] += 1
        else:
            items = [big, *fillings(capacity - big, lengths, counts, 8)[0]]
        counts[big] += 1
        need: dict[int, int] = {}
        for x in items:
            need[x] = need.get(x, 0) + 1
        times = min(counts[x] // n for x, n in need.items())
        for x, n in need.items():
            counts[x] -= n * times
        lengths = [x for x in lengths if counts[x] > 0] if any(counts[x] == 0 for x in need) else lengths
        out.append((times, items))
    return out


def volume_bound(histogram: dict[int, int], capacity: int = CAPACITY) -> int:
    """Bins that no packing can do without."""
    volume = sum(k * v for k, v in histogram.items())
    return max(-(-volume // capacity), sum(v for k, v in histogram.items() if 2 * k > capacity))


def bin_completion(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[tuple[int, list[int]]]:
    """As few bins as found: (times, lengths) each. The search runs at every size and takes at most about `nodes`
    steps; the result is exact when it meets the volume bound or the search ends within them."""
    histogram = {int(k): int(v) for k, v in histogram.items() if v > 0}
    if not histogram:
        return []
    size = lambda bins: sum(t for t, _ in bins)
    volume = sum(k * v for k, v in histogram.items())
    bound = volume_bound(histogram, capacity)
    best = min(best_fit(histogram, capacity), _greedy(histogram, capacity, True), _greedy(histogram, capacity, False), key=size)
    fewest = size(best)
    if fewest == bound:
        return best
    counts, bins, spent = dict(histogram), [], 0
    seen: dict[int, int] = {}

    def take(times: int, need: dict[int, int]) -> None:
        for x, n in need.items():
            counts[x] -= n * times

    def choices(used: int, waste: int) -> Iterator[tuple[int, list[int], dict[int, int], int]]:
        """What may be done with the largest length: each filling beside it, as often as the counts allow and less."""
        nonlocal best, fewest, spent
        lengths = sorted(k for k, v in counts.items() if v)
        spent += 1 + len(counts) // 16
        if not lengths:
            if used < fewest:
                best, fewest = list(bins), used
            return
        if -(-(volume + waste) // capacity) >= fewest:
            return
        state = hash(tuple(counts.values()))
        if seen.get(state, fewest) <= used:
            return
        seen[state] = used
        big = lengths[-1]
        counts[big] -= 1
        options, _, steps = _fillings(capacity - big, lengths, counts, max(50 * FILLINGS, (nodes - spent) // 4), False)
        options = undominated(options, capacity - big, counts) or options
        counts[big] += 1
        spent += steps
        for items in options:
            whole = [big, *items]
            need = {x: whole.count(x) for x in whole}
            for times in range(min(counts[x] // n for x, n in need.items()), 0, -1):
                yield times, whole, need, capacity - sum(whole)

    # An explicit stack: at full size a packing has thousands of different fillings.
    stack = [(choices(0, 0), 0, 0)]
    while stack and spent <= nodes and fewest > bound:
        tried, used, waste = stack[-1]
        step = next(tried, None)
        if step is None:
            stack.pop()
            if stack:
                times, whole = bins.pop()
                take(-times, {x: whole.count(x) for x in whole})
            continue
        times, whole, need, lost = step
        take(times, need)
        bins.append((times, whole))
        stack.append((choices(used + times, waste + lost * times), used + times, waste + lost * times))
    return best


def _slots(bins: list[tuple[int, list[int]]]) -> list[tuple[int, int, int, int, int, int]]:
    """(length, first rank, ranks, copies, first sequence, offset): rank r of a length lies in sequence
    first + (r - first rank) div copies, at offset + (r - first rank) mod copies * length."""
    taken: dict[int, int] = {}
    rows, sequence = [], 0
    for times, items in bins:
        offset = 0
        for length in dict.fromkeys(items):
            copies = items.count(length)
            rows.append((length, taken.get(length, 0), times * copies, copies, sequence, offset))
            taken[length] = taken.get(length, 0) + times * copies
            offset += copies * length
        sequence += times
    return rows


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    A null or empty text is the end id alone. Longer texts are cut at multiples of `capacity`, whose full
    pieces each fill a sequence. Repeated rows are packed as often as they occur; null ids are kept; an
    empty table gives no rows.
    """
    spark = docs.sparkSession
    pieces = cut(docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(_pieces(tokenizer_path, capacity, end_id), PIECES))
    histogram = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # at most `capacity` rows
    parts = pieces_for(sum(histogram.values()), 200_000)
    slots = spark.createDataFrame(_slots(bin_completion(histogram, capacity)), "s_length bigint, s_first bigint, s_ranks bigint, copies bigint, sequence bigint, s_offset bigint")
    # Rank within a length: a row number in each salted part, after the counts of the parts before it.
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "ids_crc32"), F.lit(parts)))
    sizes = dealt.groupBy("length", "part").count()
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "part").orderBy(F.col("id").asc_nulls_last(), "piece", "ids_crc32")
    ranked = dealt.withColumn("n", F.row_number().over(within)).join(offsets, ["length", "part"]).withColumn("rank", F.col("before") + F.col("n") - 1)
    # The table of fillings has about one row for each length and filling, whatever the number of pieces.
    placed = ranked.join(F.broadcast(slots), (F.col("length") == F.col("s_length")) & (F.col("rank") >= F.col("s_first")) & (F.col("rank") < F.col("s_first") + F.col("s_ranks")))
    step = F.col("rank") - F.col("s_first")
    return placed.select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.floor(step / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("s_offset") + F.pmod(step, F.col("copies")) * F.col("length")).cast("long").alias("offset"),
    )


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
