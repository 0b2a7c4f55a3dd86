import random

import pytest

import corpus_pipeline
from bindery.llm.near_copies import shingles


def jaccard(a, b):
    five = lambda t: {tuple(w[i : i + 5]) for w in [t.lower().split()] for i in range(max(1, len(w) - 4))}
    x, y = five(a), five(b)
    return len(x & y) / len(x | y)


def kept_by_brute_force(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for k, (i, a) in enumerate(rows):
        for j, b in rows[:k]:
            if jaccard(a, b) >= 0.8:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return {i for i, _ in rows if find(i) == i}


@pytest.mark.parametrize("seed", [1, 2])
def test_stage_drops_the_copies_at_080(spark, seed):
    r = random.Random(seed)
    word = lambda: f"w{r.randrange(5000)}"
    rows = []
    for _ in range(30):
        base = [word() for _ in range(r.randint(60, 400))]
        rows.append(" ".join(base))
        for edits in (1, 2, 3, 5, 8):  # each changed word changes five shingles
            w = list(base)
            for at in r.sample(range(len(w)), edits):
                w[at] = word()
            rows.append(" ".join(w))
    long = [word() for _ in range(200)]
    rows += [" ".join(long[:200 - 12 * k] + [word() for _ in range(12 * k)]) for k in range(6)]  # a chain
    rows += ["short text", "Short  text", "other short text", ""]
    docs = [(i, t) for i, t in enumerate(rows)]
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {x.doc_id for x in corpus_pipeline.drop_near_copies(spark, df, "").collect()}
    assert got == kept_by_brute_force(docs)
    assert len(got) < len(docs) / 2


def test_shingles_and_null_ids(spark):
    assert len(shingles("a b c d e f")) == 2 and len(shingles("a")) == len(shingles(None)) == 1
    text = " ".join(f"v{i}" for i in range(100))
    df = spark.createDataFrame([(None, text + " x"), (4, text), (3, text + " y"), (None, "alone")], "doc_id bigint, text string")
    assert {(x.doc_id, x.text) for x in corpus_pipeline.drop_near_copies(spark, df, "").collect()} == {(3, text + " y"), (None, "alone")}
    assert corpus_pipeline.drop_near_copies(spark, df.limit(0), "").count() == 0
