"""Byte-level BPE by longest matches and backtracking, in time linear in the text.

A sequence of tokens is what the merges give exactly when each two neighbours are (of a vocabulary whose tokens
are made of tokens of lower rank; `Vocabulary` checks this). So a word is encoded from left to right: of
the tokens that begin at a place the longest comes first, then the next shorter ones, until one goes with its left
neighbour; where none does, the neighbour is taken back, and no place is tried again. An Aho-Corasick automaton
over the bytes, written as Latin-1, finds the tokens at all places. Whether two tokens may stand side by side is
found by undoing their merges, and remembered for each pair.
"""

from __future__ import annotations

import base64
import hashlib
import unicodedata
from collections.abc import Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import per_worker, table

#: Distinct words, and pairs of tokens, that a Python worker keeps; each is emptied when it is full.
MEMO = 800_000
#: Code points of a text that are cut into words at a time.
SEGMENT = 1 << 18
ROWS = 512


class Vocabulary:
    """Token bytes and ranks of a tiktoken file, with the two tokens that each token is merged from."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.rank = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.bytes_of = {r: t for t, r in self.rank.items()}
        self.decimal = {r: str(r) for r in self.bytes_of}
        self.automaton = ahocorasick.Automaton()
        for token, r in self.rank.items():
            self.automaton.add_word(token.decode("latin-1"), (len(token) - 1, r))
        self.automaton.make_automaton()
        ids = 1 + max(self.bytes_of)
        #: Bytes of each token, the longest shorter token that begins it (-1: none), and the parts of its last merge.
        self.size, self.shorter = [0] * ids, [-1] * ids
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.pairs: dict[tuple[int, int], bool] = {}
        for token, r in self.rank.items():
            prefixes = (token[:k] for k in range(len(token) - 1, 0, -1))
            self.size[r], self.shorter[r] = len(token), next((self.rank[p] for p in prefixes if p in self.rank), -1)
        for token, r in sorted(self.rank.items(), key=lambda x: (len(x[0]), x[1])):
            self.parts[r] = self._halves(token) if len(token) > 1 else None

    def _halves(self, token: bytes) -> tuple[int, int]:
        """The cut of a token into two tokens that may stand side by side but for the token itself."""
        r = self.rank[token]
        for k in range(1, len(token)):
            a, b = self.rank.get(token[:k]), self.rank.get(token[k:])
            if a is not None and b is not None and (len(token[:k]) == 1 or a < r) and (len(token[k:]) == 1 or b < r) and self._side_by_side(a, b, r):
                return a, b
        raise ValueError(f"no merges lead to the token {token!r}")

    def _side_by_side(self, a: int, b: int, until: int | None = None) -> bool:
        """Whether merges stop at a, b: going back in time from the two tokens to single bytes, the last token of the left
        and the first of the right part never have a merge that would have come first. Of merges of equal rank the
        left one comes first. `until`: only merges of lower rank count."""
        end = len(self.size) if until is None else until
        left, right, left_end, right_end = a, b, end, end
        while True:
            joined = self.rank.get(self.bytes_of[left] + self.bytes_of[right])
            if joined is not None and joined < left_end and (joined < right_end or (joined == right_end and right_end < end)):
                return False
            in_left, in_right = self.parts[left], self.parts[right]
            if in_left is None and in_right is None:
                return True
            if in_right is None or (in_left is not None and left > right):
                left, left_end = in_left[1], left
            else:
                right, right_end = in_right[0], right

    def fits(self, a: int, b: int) -> bool:
        known = self.pairs.get((a, b))
        if known is None:
            if len(self.pairs) >= MEMO:
                self.pairs.clear()
            known = self.pairs[a, b] = self._side_by_side(a, b)
        return known

    def encode_word(self, word: bytes) -> tuple[int, ...]:
        whole = self.rank.get(word)
        if whole is not None or not word:
            return (whole,) if word else ()
        n = len(word)
        longest = [0] * n
        for end, (before, r) in self.automaton.iter(word.decode("latin-1")):  # ends ascend, so the longest is set last
            longest[end - before] = r
        size, shorter, pairs = self.size, self.shorter, self.pairs
        dead = bytearray(n + 1)  #: places from which no token leads on
        out: list[int] = []
        at, token, last = 0, longest[0], -1
        while at < n:
            while token >= 0:
                if not dead[at + size[token]]:
                    if last < 0:
                        break
                    fit = pairs.get((last, token))
                    if fit is None:
                        fit = self.fits(last, token)
                    if fit:
                        break
                token = shorter[token]
            if token < 0:
                dead[at] = 1
                at -= size[last]
                token = shorter[last]
                out.pop()
                last = out[-1] if out else -1
            else:
                out.append(token)
                at += size[token]
                last, token = token, longest[at] if at < n else -1
        return tuple(out)


def newer_characters() -> str:
    """Letters and numbers of this regex module's tables that the tiktoken library's older tables do not have."""
    import tiktoken

    unsure = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and unicodedata.category(chr(c)) == "Cn"]
    letters = regex.findall(r"[\p{L}\p{N}]", "".join(unsure))
    known = tiktoken.Encoding("classes", pat_str=r"[\p{L}\p{N}]", mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
    return "".join(c for c in letters if not known.encode_ordinary(c))


class ByteBpe(Vocabulary):
    def __init__(self, path: str, pattern: str):
        super().__init__(path)
        self.pattern = regex.compile(pattern)
        self.between = regex.compile(r"(?<=\S) (?=\S)")
        self.newer = dict.fromkeys(newer_characters(), "\u0378")
        self.memo: dict[str, tuple[int, ...]] = {}

    def _words(self, text: str) -> list[str]:
        """Matches of the pattern, by the classes of characters that the tiktoken library knows: letters that are newer than its
        tables stand for themselves but count as other characters (U+0378, which has no class, in their place)."""
        if text.isascii() or self.newer.keys().isdisjoint(text):
            return self.pattern.findall(text)
        return [text[m.start() : m.end()] for m in self.pattern.finditer("".join([self.newer.get(c, c) for c in text]))]

    def words(self, text: str) -> Iterator[list[str]]:
        """Words, some 100,000 at a time: a single space between two other characters always begins a word."""
        at = 0
        while len(text) - at > SEGMENT:
            cut = self.between.search(text, at + SEGMENT)
            if cut is None:
                break
            yield self._words(text[at : cut.start()])
            at = cut.start()
        yield self._words(text[at:] if at else text)

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        memo = self.memo
        for words in self.words(text):
            new = set(words).difference(memo)
            if len(memo) + len(new) > MEMO:
                memo.clear()
                new = set(words)
            for w in new:
                memo[w] = self.encode_word(w.encode("utf-8", "surrogatepass"))
            ids.extend(chain.from_iterable(map(memo.__getitem__, words)))
        return ids

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@per_worker
def encoder(path: str, pattern: str) -> ByteBpe:
    return ByteBpe(path, pattern)


def _coded(path: str, pattern: str, digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = encoder(path, pattern)
        for batch in batches:
            for s in range(0, batch.num_rows, ROWS):
                part = batch.slice(s, ROWS)
                sizes, first, second = [], [], []
                for text in part.column(1).to_pylist():
                    ids = bpe.encode(text or "")
                    decoded = bpe.decode(ids)
                    sizes.append(len(ids))
                    first.append(hashlib.sha256(",".join(map(bpe.decimal.__getitem__, ids)).encode()).hexdigest() if digests else ids)
                    second.append(hashlib.sha256(decoded).hexdigest() if digests else decoded)
                types = (pa.string(), pa.string()) if digests else (pa.list_(pa.int32()), pa.binary())
                names = ["ids_sha256", "decoded_sha256"] if digests else ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sizes, pa.int64()), pa.array(first, types[0]), pa.array(second, types[1])], names=["id", "n_tokens", *names])

    return run


def encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids, decoded (bytes) of every text, or the SHA-256 of the last two with `digests` (ids in decimal,
    joined by commas).

    A null text counts as empty and gives no ids; repeated rows and null ids stay; an empty table gives no
    rows; other columns are not read. Texts are encoded where they are read, whatever their length; a worker
    keeps a bounded number of words and pairs of tokens.
    """
    schema = "id bigint, n_tokens bigint, " + ("ids_sha256 string, decoded_sha256 string" if digests else "ids array<int>, decoded binary")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_coded(ranks_path, pattern, digests), schema).withColumnRenamed("id", id_col)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN, digests=True)
