"""Language-model scores from a weighted backoff automaton.

Counting: texts are dealt into shards of bounded size. A shard lists its distinct n-grams (64-bit hashes
of words, 56-bit hashes of longer n-grams) with their training counts and sends them, packed, to buckets
by hash; a bucket adds the shards' counts up and answers each shard in the order of its list, about a
byte for each n-gram. A shard sends nothing where it has no n-gram, so lists are never more than n-grams. What
moves grows with the distinct n-grams of the input, no word is a hot key, and no model is broadcast, only the
number of tokens and of different ones.

Scoring: from the answers a shard builds the part of the automaton that its texts can visit. States are
the contexts seen in training, arcs the seen n-grams, and each state has a failure arc to its longest
suffix. Smoothing is Bayesian with a Dirichlet prior on the shorter context:
P(w|h) = (c(hw) + k P(w|h')) / (c(h) + k), so a failure arc weighs k / (c(h) + k); below all contexts
stands the add-one unigram model, whose arcs match every word. Arc weights are computed once for each n-gram,
shorter ones first. One left-to-right traversal, in step over all texts of a shard, carries the state: it takes
the word's arc if the state has one and else the failure arc to try again, and adds up log10 probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery.llm.common import TO_SPACE, pieces_for, table, text_bytes

SHARD_BYTES = 16_000_000
#: Prior weights of contexts of one and two words.
PRIOR = (200.0, 4.0)
HELD_OUT = (7, 2)
END = np.uint64(0x9E3779B97F4A7C15)
SCORES = "id string, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"

_rng = np.random.default_rng(20)
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words in order, A-Z in lower case, and the number of words of each text."""
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.diff(np.r_[True, space].astype(np.int8))
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    if len(raw) and not len(end):
        return np.empty(0, np.uint64), np.zeros(len(texts), np.int64)
    size = end - begin
    powers = np.cumprod(np.full(int(size.max(initial=1)), 0xD6E8FEB86659FD93 | 1, np.uint64))
    place = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    values = _BYTE[_LOWER[raw[~space]]] * powers[place]
    hashes = mix(np.add.reduceat(values, np.cumsum(size) - size) + size.astype(np.uint64)) if len(size) else np.empty(0, np.uint64)
    starts = np.cumsum([0, *(len(t) + 1 for t in texts)])
    at = np.searchsorted(begin, starts)
    return hashes, np.diff(at)


def distinct_of(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values, and for each value its place among them, with indexes of 32 bits and few arrays at a time."""
    order = np.argsort(h).astype(np.uint32) if len(h) < 1 << 31 else np.argsort(h)
    ordered = h[order]
    first = np.ones(len(h), bool)
    np.not_equal(ordered[1:], ordered[:-1], out=first[1:])
    values = ordered[first]
    del ordered
    place = np.cumsum(first, dtype=np.int32)
    place -= 1
    inverse = np.empty(len(h), np.int32)
    inverse[order] = place
    return values, inverse


class Shard:
    """Token hashes of a shard's texts, an end token after each, and its n-grams."""

    def __init__(self, held_out: np.ndarray, texts: list[str | None]):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        hashes, sizes = [], []
        total, part = 0, []
        for b in [*raw, None]:
            if b is None or total > 2_000_000:
                h, n = word_hashes(part)
                hashes.append(h)
                sizes.append(n)
                total, part = 0, []
            if b is not None:
                total += len(b)
                part.append(b)
        n = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
        self.n = n + 1
        ends = np.cumsum(self.n)
        self.start = ends - self.n
        self.tokens = np.full(int(self.n.sum()), END, np.uint64)
        inner = np.ones(len(self.tokens), bool)
        inner[ends - 1] = False
        self.tokens[inner] = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.held_out = held_out
        self.place = np.arange(len(self.tokens)) - np.repeat(self.start, self.n)

    def grams(self, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted distinct hashes of an order, the index of each position's n-gram (-1: none), training counts."""
        h = self.tokens
        if order > 1:
            h = self.tokens.copy()
            for k in range(1, order):
                before = np.r_[np.zeros(k, np.uint64), self.tokens[:-k]] if len(h) > k else np.zeros(len(h), np.uint64)
                h = h * np.uint64(0x9FB21C651E98DF25) + before
                del before
            h = mix(h) >> np.uint64(8)
        has = self.place >= order - 1
        h = h[has]
        distinct, inverse = distinct_of(h)
        del h
        index = np.full(len(has), -1, np.int32)
        index[has] = inverse
        train = ~np.repeat(self.held_out, self.n)[has]
        return distinct, index, np.bincount(inverse[train], minlength=len(distinct))


def packed(values: np.ndarray) -> bytes:
    """Byte planes, which general compression handles well."""
    v = np.ascontiguousarray(values, dtype="<u8")
    return zstandard.ZstdCompressor(level=1).compress(v.view(np.uint8).reshape(-1, 8).T.tobytes())


def unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, -1).T).view("<u8").reshape(-1)


def _bounds(distinct: np.ndarray, order: int, buckets: int) -> np.ndarray:
    """Where each bucket's range of hashes begins."""
    width = 1 << (64 if order == 1 else 56)
    edges = np.array([-(-width * b // buckets) for b in range(buckets)], np.uint64)
    return np.r_[np.searchsorted(distinct, edges), len(distinct)]


def _counter(order: int, buckets: int):
    def count(pdf: pd.DataFrame) -> pd.DataFrame:
        shard = Shard(pdf["held_out"].to_numpy(bool), pdf["text"].tolist())
        rows = []
        for k in range(1, order + 1):
            distinct, _, counts = shard.grams(k)
            at = _bounds(distinct, k, buckets)
            for b in range(buckets):
                h = distinct[at[b] : at[b + 1]]
                if len(h):
                    rows.append((b * order + k - 1, int(pdf["shard"].iloc[0]), packed(np.diff(np.r_[np.uint64(0), h])), packed(counts[at[b] : at[b + 1]])))
        return pd.DataFrame(rows, columns=["bucket", "shard", "hashes", "counts"])

    return count


def _merger(order: int):
    def merge(pdf: pd.DataFrame) -> pd.DataFrame:
        hashes = [np.cumsum(unpacked(b), dtype=np.uint64) for b in pdf.pop("hashes")]
        ends = np.cumsum([len(h) for h in hashes])
        joined = np.concatenate(hashes)
        del hashes
        distinct, inverse = distinct_of(joined)
        del joined
        total = np.zeros(len(distinct), np.int64)
        # A list names each n-gram once.
        for begin, end, b in zip([0, *ends], ends, pdf.pop("counts"), strict=False):
            total[inverse[begin:end]] += unpacked(b).astype(np.int64)
        answers = [total[inverse[begin:end]] for begin, end in zip([0, *ends], ends, strict=False)]
        # The bucket's share of N and V stands in one row.
        once = (np.arange(len(pdf)) == 0) & bool(pdf["bucket"].iloc[0] % order == 0)
        return pd.DataFrame({
            "bucket": pdf["bucket"], "shard": pdf["shard"], "totals": [packed(a) for a in answers],
            "n": once * int(total.sum()), "v": once * int((total > 0).sum()),
        })

    return merge


class Automaton:
    """States, arcs and failure arcs over the n-grams of one shard. The context of an n-gram of order k with
    index i is a state if training has it; its failure arc leads to the context without its first word. An arc is
    an n-gram that training has, named by order and index; the root, order 1, has an arc for every word."""

    def __init__(self, index: list[np.ndarray], totals: list[np.ndarray], n: int, v: int, prior: tuple[float, ...]):
        self.index, self.totals = index, totals
        self.arcs = [np.log10((totals[0] + 1.0) / (n + v + 1.0))]
        self.fails = [np.log10(k / (t + k)) for t, k in zip(totals[:-1], prior, strict=True)]
        for k, weight in enumerate(prior, 1):
            at = np.flatnonzero(index[k] >= 0)
            which = index[k][at]
            context, shorter = np.empty(len(totals[k]), np.int32), np.empty(len(totals[k]), np.int32)
            context[which], shorter[which] = index[k - 1][at - 1], index[k - 1][at]
            below = 10.0 ** self.arcs[k - 1][shorter]  # training has the shorter n-gram if it has this one
            self.arcs.append(np.log10((totals[k] + weight * below) / (totals[k - 1][context] + weight)))

    def traverse(self, shard: Shard) -> np.ndarray:
        """log10 probability of each text."""
        index, totals = self.index, self.totals
        order = len(index)
        by_size = np.argsort(-shard.n, kind="stable")
        start, n = shard.start[by_size], shard.n[by_size]
        score = np.zeros(len(n))
        length = np.zeros(len(n), np.int64)  # words in the state's context
        last = int(n.max(initial=0))
        alive = np.searchsorted(-n, -np.arange(last), "left")
        for t in range(last):
            m = alive[t]
            at, state = start[:m] + t, length[:m]
            left = np.arange(m)  # texts that have not found their arc
            for k in range(order - 1, -1, -1):
                now = state[left] == k  # the other states are shorter
                here, left = left[now], left[~now]
                if not here.size:
                    continue
                gram = index[k][at[here]]
                match = totals[k][gram] > 0 if k else np.ones(len(here), bool)
                score[here[match]] += self.arcs[k][gram[match]]
                failed = here[~match]
                if failed.size:
                    score[failed] += self.fails[k - 1][index[k - 1][at[failed] - 1]]
                    state[failed] = k - 1
                    left = np.concatenate([left, failed])
            # The arc of order k + 1 that was taken leads to its own context of k + 1 words, or k if that is the most.
            nxt = np.minimum(state + 1, order - 1)
            for k in range(order - 1, 0, -1):
                here = np.flatnonzero(nxt == k)
                if here.size:
                    nxt[here[totals[k - 1][index[k - 1][at[here]]] == 0]] = k - 1
            length[:m] = nxt
        out = np.empty(len(n))
        out[by_size] = score
        return out


def _scorer(order: int, prior: tuple[float, ...]):
    names = [c.split()[0] for c in SCORES.split(", ")]

    def score(docs: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        if docs.empty:
            return pd.DataFrame({c: [] for c in names})
        n, v = int(docs["all_n"].iloc[0]), int(docs["all_v"].iloc[0])
        shard = Shard(docs["held_out"].to_numpy(bool), docs.pop("text").tolist())
        own = answers.sort_values("bucket")
        index, totals = [], []
        for k in range(1, order + 1):
            at = shard.grams(k)[1]
            parts = [unpacked(b).astype(np.int64) for b in own.loc[own["bucket"] % order == k - 1, "totals"]]
            totals.append(np.concatenate(parts) if parts else np.empty(0, np.int64))
            index.append(at)
        c = totals[0][index[0]]
        base = np.add.reduceat(np.log10((c + 1.0) / (n + v + 1.0)), shard.start)
        known = np.add.reduceat((c > 0).astype(np.int64), shard.start)
        del c
        model = Automaton(index, totals, n, v, prior).traverse(shard)
        return pd.DataFrame({"id": docs["id"], "held_out": shard.held_out, "n_tokens": shard.n, "n_known": known, "train_tokens": n, "base_score": base, "score": model})[names]

    return score


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", prior: tuple[float, ...] = PRIOR, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of each row.

    A null text is empty: its only token is the end. A null id trains. Repeated rows count and are scored
    as often as they occur; a text is scored whole, however long, in one shard. len(prior) + 1 is the order of the
    model. Other columns, whatever their names, are not read. An empty table gives no rows.
    """
    order = len(prior) + 1
    ident = F.col(id_col).cast("long").cast("string")  # as text: pandas has no nulls among integers
    held_out = F.coalesce(F.crc32(ident.cast("binary")) % HELD_OUT[0] == HELD_OUT[1], F.lit(False))
    rows = docs.select(ident.alias("id"), held_out.alias("held_out"), F.col(text_col).alias("text"))
    shards = pieces_for(text_bytes(rows), shard_bytes)
    # Both uses below read this one exchange.
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("id", "text"), F.lit(shards)).cast("int")).repartition(shards, "shard")
    asked = dealt.groupBy("shard").applyInPandas(_counter(order, shards), "bucket int, shard int, hashes binary, counts binary")
    answered = asked.repartition(shards, "bucket").groupBy("bucket").applyInPandas(_merger(order), "bucket int, shard int, totals binary, n bigint, v bigint")
    back = answered.repartition(shards, "shard")
    # One row. All columns are read, or the planner would prune them and make the answers twice.
    whole = F.col("bucket").isNotNull() & F.col("shard").isNotNull() & F.col("totals").isNotNull()
    totals = back.agg(*[F.sum(F.when(whole, F.col(c))).alias(f"all_{c}") for c in ("n", "v")])
    scored = dealt.crossJoin(F.broadcast(totals)).groupBy("shard").cogroup(back.groupBy("shard")).applyInPandas(_scorer(order, prior), SCORES)
    return scored.withColumn("id", F.col("id").cast("long")).withColumnRenamed("id", id_col)


def op1_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model of those that are not held out."""
    return score_texts(table(spark, sf_dir, "documents"))
