import hashlib
import zlib
from collections import defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from bindery.llm.bpe import Bpe, encode
from bindery.llm.packing import WordEncoder, best_fit, bin_completion, fillings, pack, undominated
from cases import frame, texts

WORD, BYTE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = ["a<|endoftext|> b<|startoftext|>", "don't we'll x\x1cz\x85q", "é́ ΑΣ ΣΣ. İx ﬁ", "!?" * 900, "日本語 😀😀 \x00", "\r\n\r\n a ", "x" * 700, "Ǆ ½ ² 12345 O'Neil's"]


def library(path):
    t = Tokenizer.from_file(path)
    t.no_padding(), t.no_truncation()
    return t


def test_encoders_match_the_library():
    rows = [t or "" for _, t in texts()] + ODD
    for path, mine in ((BYTE, Bpe(BYTE)), (WORD, WordEncoder(WORD))):
        want = [e.ids for e in library(path).encode_batch(rows, add_special_tokens=False)]
        assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode_all(rows)] == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(max_size=40), max_size=6))
def test_any_text(rows):
    for path in (BYTE, WORD):
        mine = _kept[path] = _kept.get(path) or (Bpe(BYTE) if path == BYTE else WordEncoder(WORD))
        want = [library_of(path).encode(t, add_special_tokens=False).ids for t in rows]
        assert [np.frombuffer(b, "<u4").tolist() for b in mine.encode_all(rows)] == want


_kept, _libraries = {}, {}


def library_of(path):
    _libraries[path] = _libraries.get(path) or library(path)
    return _libraries[path]


def test_encode(spark):
    rows = texts()
    t = library(BYTE)
    got = encode(frame(spark, rows), BYTE, digests=True).collect()
    want = []
    for i, x in rows:
        ids = t.encode(x or "", add_special_tokens=False).ids
        want.append((str(i), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    plain = {r.doc_id: r for r in encode(frame(spark, rows[:9]), BYTE).collect()}
    assert plain[0].decoded == rows[0][1] and plain[0].ids == t.encode(rows[0][1], add_special_tokens=False).ids
    assert encode(spark.createDataFrame([], "doc_id bigint, text string"), BYTE).count() == 0


def test_pack(spark):
    rows = texts()
    t = library(WORD)
    got = pack(frame(spark, rows), WORD, capacity=64).collect()
    want = []
    for i, x in rows:
        ids = [*t.encode(x or "", add_special_tokens=False).ids, 1]
        want += [(str(i), k, s, len(ids[s : s + 64]), zlib.crc32(np.array(ids[s : s + 64], "<u4").tobytes())) for k, s in enumerate(range(0, len(ids), 64))]
    assert sorted((str(r.doc_id), r.piece, r.start, r.length, r.ids_crc32) for r in got) == sorted(want)
    bins = defaultdict(list)
    for r in got:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 64
    assert len(bins) == sum(n for n, _ in bin_completion(_count(x[3] for x in want), 64))
    assert pack(spark.createDataFrame([], "doc_id bigint, text string"), WORD).count() == 0


def _count(lengths):
    h = defaultdict(int)
    for x in lengths:
        h[x] += 1
    return h


def fewest(items, capacity):
    """Bins of an optimal packing, by search over set partitions."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, rooms):
        if len(rooms) >= best[0]:
            return
        if k == len(items):
            best[0] = len(rooms)
            return
        for j in range(len(rooms)):
            if rooms[j] >= items[k] and rooms[j] not in rooms[:j]:
                go(k + 1, [*rooms[:j], rooms[j] - items[k], *rooms[j + 1 :]])
        go(k + 1, [*rooms, capacity - items[k]])

    go(0, [])
    return best[0]


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=10))
def test_bin_completion_is_optimal_on_small_cases(items):
    bins = bin_completion(_count(items), 30)
    assert sorted(x for n, b in bins for x in b * n) == sorted(items) and all(sum(b) <= 30 for _, b in bins)
    assert sum(n for n, _ in bins) == fewest(items, 30)


def test_three_bins_beside_fillings_without_waste():
    items = [20, 19, 18, 9, 7, 6, 4, 4, 3]
    bins = bin_completion(_count(items), 30)
    assert sorted(x for n, b in bins for x in b * n) == sorted(items)
    assert sum(n for n, _ in bins) == 3


def test_the_search_runs_at_every_size():
    items = [20, 19, 18, 9, 7, 6, 4, 4, 3]
    more = _count([*items, *[30] * 1000])
    assert sum(n for n, _ in bin_completion(more, 30)) == 1003


def test_many_small_pieces_fill_a_room():
    counts = {1: 5000, 3000: 1, 2000: 1}
    assert fillings(1096, [1, 2000, 3000], counts, 8)[0] == [1] * 1096
    assert sum(n for n, _ in bin_completion(counts, 4096)) == 3


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(3, 20), min_size=8, max_size=12))
def test_bin_completion_is_optimal_on_fuller_cases(items):
    bins = bin_completion(_count(items), 30)
    assert sorted(x for n, b in bins for x in b * n) == sorted(items) and all(sum(b) <= 30 for _, b in bins)
    assert sum(n for n, _ in bins) == fewest(items, 30)


def test_fillings_fit():
    counts = {3: 2, 5: 1, 8: 1, 11: 4}
    for f in fillings(16, sorted(counts), dict(counts)):
        assert sum(f) <= 16 and all(f.count(x) <= counts[x] for x in f)
    best = max(sum(c) for n in range(5) for c in combinations([3, 3, 5, 8, 11], n) if sum(c) <= 16)
    assert sum(fillings(16, sorted(counts), dict(counts))[0]) == best


def fewest_of_subsets(items, capacity):
    """Bins and the filling of the last, over all subsets."""
    best = [(len(items) + 1, 0)] * (1 << len(items))
    best[0] = (1, 0)
    for mask, (bins, filled) in enumerate(best):
        for i, x in enumerate(items):
            if not mask >> i & 1:
                best[mask | 1 << i] = min(best[mask | 1 << i], (bins, filled + x) if filled + x <= capacity else (bins + 1, x))
    return best[-1][0]


def test_bin_completion_finds_the_fewest():
    import random
    from collections import Counter

    r = random.Random(5)
    for _ in range(300):
        capacity = r.choice([30, 60, 100])
        items = [r.randint(max(1, capacity // 9), capacity * 2 // 3) for _ in range(r.randint(6, 11))]
        bins = bin_completion(dict(Counter(items)), capacity)
        assert sum(t for t, _ in bins) == fewest_of_subsets(items, capacity)
        assert sum((Counter({x: n * t for x, n in Counter(b).items()}) for t, b in bins), Counter()) == Counter(items) and all(sum(b) <= capacity for _, b in bins)
    hard = [9, 10, 12, 13, 13, 16, 16, 16, 17, 21, 23, 24, 25, 26, 27, 30]
    assert sum(t for t, _ in bin_completion(dict(Counter(hard)), 60)) == 5


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 30), max_size=40))
def test_best_fit_piece_by_piece(items):
    rooms = []
    for x in sorted(items, reverse=True):
        tight = min((r for r in rooms if r >= x), default=None)
        if tight is None:
            rooms.append(30 - x)
        else:
            rooms[rooms.index(tight)] -= x
    bins = best_fit(_count(items), 30)
    assert sorted(x for n, b in bins for x in b * n) == sorted(items)
    assert sorted(30 - sum(b) for n, b in bins for _ in range(n)) == sorted(rooms)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 12), min_size=1, max_size=8), st.integers(5, 24))
def test_dominated_fillings_by_subsets(items, room):
    counts = _count(items)
    options = [f for f in {tuple(sorted(c)) for n in range(len(items) + 1) for c in combinations(items, n)} if sum(f) <= room]
    kept = {tuple(x) for x in undominated([list(f) for f in options], room, counts)}
    for f in options:
        left = room - sum(f)
        subsets = [c for n in range(1, len(f) + 1) for c in combinations(f, n)]
        free = [x for x in counts if counts[x] > f.count(x) and x <= room]
        worse = any(sum(c) <= x <= sum(c) + left and (len(c) > 1 or c[0] < x) for c in subsets for x in free)
        assert (f not in kept) == worse
