"""Byte-level BPE with a segment tree over the ranks of adjacent pairs.

A leaf holds rank and place of the pair that begins there, so the root is the leftmost pair of lowest
rank. Merging it changes that leaf and its two neighbours, and only their paths to the root are
computed again, until the root holds no mergeable pair. Words of like length share one array of trees:
each step merges one pair in every word that still has one.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import per_worker, table

#: Distinct chunks that a Python worker keeps encoded; the memo is emptied when it is full.
MEMO = 800_000
#: Words over this many bytes get a tree of their own.
LONG = 256
#: The public pre-tokenizer's pattern of this vocabulary.
WORDS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: The same cuts at white space only; what lies between is cut by WORDS once for each distinct chunk.
CHUNKS = r" ?\S+|\s+(?!\S)|\s+"


def _byte_letters() -> dict[str, int]:
    """Letter that stands for each byte in a byte-level vocabulary: printable bytes for themselves, the rest from U+0100 on."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merges:
    """Vocabulary and merge ranks of a byte-level BPE file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters, vocab = _byte_letters(), spec["model"]["vocab"]
        suffix = spec["model"]["end_of_word_suffix"] or ""
        raw = {t: bytes(letters[c] for c in t) for t in vocab} if not suffix else {}
        self.bytes_of = {vocab[t]: b for t, b in raw.items()}
        self.byte_id = np.array([vocab[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        self.last_id = np.array([vocab[c + suffix] for c, _ in sorted(letters.items(), key=lambda x: x[1])], np.int32)
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        keys = np.array([(vocab[a] << 32) | vocab[b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.bytes_of |= {i: t.encode() for t, i in self.special.items()}

    def _rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair; the number of merges where there is none."""
        key = (a.astype(np.int64) << np.int64(32)) | b.astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], len(self.merged))

    def _trees(self, words: list[bytes], width: int) -> list[bytes]:
        """Ids of words of at most `width` bytes, a power of two; one segment tree for each."""
        n, none = len(words), len(self.merged)
        kind = np.int32 if (none + 1) * width < 1 << 31 else np.int64
        size = np.fromiter(map(len, words), np.int64, n)
        start = np.cumsum(size) - size
        row, flat = np.repeat(np.arange(n), size), np.frombuffer(b"".join(words), np.uint8)
        place = np.arange(len(flat)) - start[row]
        ids = np.full((n, width + 1), -1, np.int32)
        ids[row, place] = self.byte_id[flat]
        ids[np.arange(n), size - 1] = self.last_id[flat[start + size - 1]]
        after = np.tile(np.arange(1, width + 2, dtype=np.int32), (n, 1))
        before = np.tile(np.arange(-1, width, dtype=np.int32), (n, 1))
        tree = np.full((n, 2 * width), none * width, kind)
        inner = place + 1 < size[row]
        r, p = row[inner], place[inner]
        tree[r, width + p] = self._rank(ids[r, p], ids[r, p + 1]) * width + p
        level = width // 2
        while level:
            tree[:, level : 2 * level] = np.minimum(tree[:, 2 * level : 4 * level : 2], tree[:, 2 * level + 1 : 4 * level : 2])
            level //= 2
        flat_tree, base = tree.reshape(-1), np.arange(n) * (2 * width)

        def update(r: np.ndarray, leaf: np.ndarray, value: np.ndarray | int) -> None:
            node, root = leaf + width, base[r]
            flat_tree[root + node] = value
            while node.size and node[0] > 1:
                node = node >> 1
                two = root + 2 * node
                flat_tree[root + node] = np.minimum(flat_tree[two], flat_tree[two + 1])

        live = np.flatnonzero(tree[:, 1] < none * width)
        while live.size:
            rank, at = np.divmod(tree[live, 1], width)
            nxt = after[live, at]
            far = after[live, nxt]
            ids[live, at] = self.merged[rank]
            ids[live, nxt] = -1
            after[live, at] = far
            before[live, np.minimum(far, width)] = at
            prev, right = before[live, at], ids[live, np.minimum(far, width)]
            ahead, back = right >= 0, prev >= 0
            fresh = self._rank(np.r_[ids[live, at], ids[live[back], prev[back]]], np.r_[np.where(ahead, right, 0), ids[live[back], at[back]]])
            update(live, nxt, none * width)
            update(live, at, np.where(ahead, fresh[: len(live)], none) * width + at)
            update(live[back], prev[back], fresh[len(live) :] * width + prev[back])
            live = live[tree[live, 1] < none * width]
        kept = ids >= 0
        out, ends = ids[kept].astype("<u4").tobytes(), (np.cumsum(kept.sum(1)) * 4).tolist()
        return [out[s:e] for s, e in zip([0, *ends], ends, strict=False)]

    @cached_property
    def rank_of(self) -> dict[int, int]:
        return dict(zip(self.keys.tolist(), self.ranks.tolist(), strict=True))

    def _tree(self, word: bytes) -> bytes:
        """The same for one long word, whose many merges come one after another."""
        n, none = len(word), len(self.merged)
        width = 1 << max(1, (n - 1).bit_length())
        ids = [*self.byte_id[np.frombuffer(word, np.uint8)].tolist()]
        ids[-1] = int(self.last_id[word[-1]])
        rank_of, merged = self.rank_of, self.merged.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        last = none * width
        tree = [last] * (2 * width)
        for p in range(n - 1):
            tree[width + p] = rank_of.get(ids[p] << 32 | ids[p + 1], none) * width + p
        for k in range(width - 1, 0, -1):
            tree[k] = min(tree[2 * k], tree[2 * k + 1])
        while tree[1] < last:
            rank, at = divmod(tree[1], width)
            gone = after[at]
            ids[at], after[at] = merged[rank], after[gone] if gone < n else n
            far, prev = after[at], before[at]
            if far < n:
                before[far] = at
            ids[gone] = -1
            changed = [(gone, last), (at, rank_of.get(ids[at] << 32 | ids[far], none) * width + at if far < n else last)]
            if prev >= 0:
                changed.append((prev, rank_of.get(ids[prev] << 32 | ids[at], none) * width + prev))
            for leaf, value in changed:
                k = leaf + width
                tree[k] = value
                while k > 1:
                    k >>= 1
                    low = min(tree[2 * k], tree[2 * k + 1])
                    if tree[k] == low:
                        break
                    tree[k] = low
        return np.array([i for i in ids if i >= 0], "<u4").tobytes()

    def encode_words(self, words: list[bytes]) -> list[bytes]:
        """Little-endian 32-bit ids of each non-empty word."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        order = np.argsort(sizes, kind="stable")
        sizes = sizes[order]
        ordered, coded = [words[k] for k in order.tolist()], []
        while len(coded) < len(words):
            begin = len(coded)
            width = 1 << max(1, (int(sizes[begin]) - 1).bit_length())
            if width > LONG:
                coded += map(self._tree, ordered[begin:])
                break
            end = min(int(np.searchsorted(sizes, width, "right")), begin + max(1, (1 << 18) // width))
            coded += self._trees(ordered[begin:end], width)
        back = np.empty(len(words), np.int64)
        back[order] = np.arange(len(words))
        return [coded[k] for k in back.tolist()]


class Bpe(Merges):
    def __init__(self, path: str):
        super().__init__(path)
        self.chunks, self.words = regex.compile(CHUNKS), regex.compile(WORDS)
        self.split = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")") if self.special else None
        self.memo: dict[str, bytes] = {}

    def _learn(self, chunks: list[str]) -> None:
        """Most chunks are one word; others are cut by the pattern and put together again."""
        whole = [c for c in chunks if c[1:].isalpha() and (c[0] == " " or c[0].isalpha())]
        rest = [c for c in chunks if not (c[1:].isalpha() and (c[0] == " " or c[0].isalpha()))]
        parts = [[w.encode("utf-8", "surrogatepass") for w in self.words.findall(c)] for c in rest]
        one = [c.encode("utf-8", "surrogatepass") for c in whole]
        distinct = list({w for p in parts for w in p}.difference(one))
        coded = self.encode_words(one + distinct)
        self.memo.update(zip(whole, coded, strict=False))
        ids = dict(zip(one + distinct, coded, strict=True))
        self.memo.update((c, b"".join([ids[w] for w in p])) for c, p in zip(rest, parts, strict=True))

    def encode_all(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text; strings of special tokens become their ids."""
        pieces = [self.split.split(t or "") if self.split and "<|" in (t or "") else [t or ""] for t in texts]
        chunked = [[p if k % 2 else self.chunks.findall(p) for k, p in enumerate(ps)] for ps in pieces]
        seen = set().union(*(p for ps in chunked for p in ps if not isinstance(p, str)))
        new = seen.difference(self.memo)
        if len(self.memo) + len(new) > MEMO:
            self.memo.clear()
            new = seen
        if new:
            self._learn(list(new))
        special = {t: np.uint32(i).astype("<u4").tobytes() for t, i in self.special.items()}
        get = self.memo.__getitem__
        return [b"".join([special[p] if isinstance(p, str) else b"".join(map(get, p)) for p in ps]) for ps in chunked]

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.bytes_of.__getitem__, memoryview(ids).cast("I"))).decode("utf-8", "replace")


@per_worker
def bpe_of(path: str) -> Bpe:
    """One for each Python worker, which Spark uses again for later tasks."""
    return Bpe(path)


def _coded(path: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = bpe_of(path)
        for batch in batches:
            for s in range(0, batch.num_rows, 2048):
                part = batch.slice(s, 2048)
                ids = bpe.encode_all(part.column(1).to_pylist())
                texts = [bpe.decode(i) for i in ids]
                n = pa.array([len(i) // 4 for i in ids], pa.int64())
                if digests:
                    sha = lambda b: hashlib.sha256(b).hexdigest()
                    yield pa.RecordBatch.from_arrays([part.column(0), n, pa.array([sha(i) for i in ids]), pa.array([sha(t.encode("utf-8", "surrogatepass")) for t in texts])], names=["id", "n_tokens", "ids_sha256", "decoded_sha256"])
                else:
                    lists = pa.array([np.frombuffer(i, "<u4").astype(np.int32) for i in ids], pa.list_(pa.int32()))
                    yield pa.RecordBatch.from_arrays([part.column(0), n, lists, pa.array(texts, pa.string())], names=["id", "n_tokens", "ids", "decoded"])

    return run


def encode(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, decoded of every text, or the SHA-256 of the last two with `digests`.

    A null text counts as empty and gives no ids; rows, repeated ones too, keep their number; null ids stay
    null; an empty table gives no rows. No shuffle: each task keeps a bounded memo of encoded chunks.
    """
    schema = "id bigint, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_coded(tokenizer_path, digests), schema).withColumnRenamed("id", id_col)


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), digests=True)
