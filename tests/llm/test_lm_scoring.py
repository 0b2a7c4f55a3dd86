import math
import re
import zlib
from collections import Counter

import pytest

from bindery.llm.lm_scoring import packed, score_texts, unpacked
from cases import frame, texts


def brute(rows, prior):
    order = len(prior) + 1
    toks = [([w.encode().lower() for w in re.findall(r"[^\x20\x09-\x0D]+", t or "")] + [None]) for _, t in rows]
    held = [i is not None and zlib.crc32(str(i).encode()) % 7 == 2 for i, _ in rows]
    counts = Counter(tuple(w[s : s + k]) for w, h in zip(toks, held, strict=True) if not h for k in range(1, order + 1) for s in range(len(w) - k + 1))
    n = sum(v for k, v in counts.items() if len(k) == 1)
    v = sum(1 for k in counts if len(k) == 1)

    def p(word, context):
        if not context:
            return (counts[(word,)] + 1) / (n + v + 1)
        c, low = counts[context], p(word, context[1:])
        k = prior[len(context) - 1]
        return (counts[(*context, word)] + k * low) / (c + k) if c else low

    out = []
    for (i, _), w, h in zip(rows, toks, held, strict=True):
        base = sum(math.log10((counts[(x,)] + 1) / (n + v + 1)) for x in w)
        full = sum(math.log10(p(x, tuple(w[max(0, j - order + 1) : j]))) for j, x in enumerate(w))
        out.append((str(i), h, len(w), sum(counts[(x,)] > 0 for x in w), n, round(base, 6), round(full, 6)))
    return sorted(out)


@pytest.mark.parametrize(("prior", "each"), [((200.0, 4.0), 10_000), ((3.0,), 24_000_000), ((5.0, 2.0, 1.0), 40_000)])
def test_scores_match_brute_force(spark, prior, each):
    rows = texts()
    got = score_texts(frame(spark, rows), prior=prior, shard_bytes=each).collect()
    mine = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6), round(r.score, 6)) for r in got)
    want = brute(rows, prior)
    assert [m[:5] for m in mine] == [w[:5] for w in want]
    for m, w in zip(mine, want, strict=True):
        assert m[5] == pytest.approx(w[5], rel=1e-9, abs=1e-5) and m[6] == pytest.approx(w[6], rel=1e-9, abs=1e-5)


def test_empty_and_packing(spark):
    assert score_texts(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0
    import numpy as np

    v = np.random.default_rng(1).integers(0, 1 << 40, 1000, dtype=np.uint64)
    assert (unpacked(packed(v)) == v).all() and len(unpacked(packed(v[:0]))) == 0
