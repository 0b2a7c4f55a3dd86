import hashlib
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
from pyspark.sql import functions as F

from bindery.llm import pii, preference, quality
from cases import frame, texts

BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def fine(kind, m):
    d = re.sub("[^0-9]", "", m)
    if kind == "ip":
        return all(int(x) <= 255 for x in m.split("."))
    if kind == "phone":
        return 9 <= len(d) <= 15
    if kind == "card":
        return 13 <= len(d) <= 19 and sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0
    return True


def brute(t):
    return [(k, m.start(), m.end()) for k, p in BASE.items() for m in re.finditer(p, t or "") if fine(k, m[0])]


HARD = [
    "a@b.c @d.e x@y@z.com a@b.cd_e@f.gh", "é😀 me.you+1@mail-x.example.co.uk, 1.2.3.4.5.6.7.8 999.1.1.1 0001.02.3.255", "4111 1111 1111 1111 and 4111-1111-1111-1112 12",
    "+1 (212) 555-0199 or +44 20 7946 0958. +1-", "9" * 4000, "a." * 3000 + "@x", "x@" + "a." * 3000 + "b", "call 212-555-0100 now", "someone (at) site (dot) org", "+" * 2000 + "1 2",
]


def test_base_spans(spark):
    r = random.Random(3)
    pool = ["user.1@mail.example.com", "10.0.0.1", "300.1.1.1", "4539578763621486", "4539578763621487", "+1 (555) 010-2020", "5-5", "@", "+", ".", "-", "é", "😀", "word", "12", "(", ")"]
    rows = [*texts(), *[(300 + i, t) for i, t in enumerate(HARD)], *[(400 + i, r.choice(["", " "]).join(r.choice(pool) for _ in range(r.randint(1, 12)))) for i in range(120)]]
    got = pii.find(frame(spark, rows)).select("doc_id", "text", pii.listed(F.col("base")).alias("b"), pii.listed(F.col("all")).alias("a")).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.b == ",".join(f"{k}:{s}:{e}" for k, s, e in brute(x.text)), x.text[:80]
        assert set(x.b.split(",")) - {""} <= set(x.a.split(","))
    assert pii.find(spark.createDataFrame([], "doc_id bigint, text string")).count() == 0


def test_the_query_counts_each_kind(spark, tmp_path):
    rows = [*texts(), *[(300 + i, t) for i, t in enumerate(HARD)], (500, "1.1.1.1 2.2.2.2 3.3.3.3 a@b.cd +1 (212) 555-0199"), (501, "a@b.cd e@f.gh 4539578763621486 i@j.kl"), (502, "+1 212 555 0199, +44 20 7946 0958; 9.9.9.9")]
    frame(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((str(r.doc_id), r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) for r in pii.op6_pii(spark, str(tmp_path)).collect())
    want = []
    for i, t in rows:
        spans = brute(t)
        n = Counter(k for k, _, _ in spans)
        want.append((str(i), n["email"], n["ip"], n["card"], n["phone"], hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()))
    assert got == sorted(want)
    assert any(x[2] > 2 for x in got)


def test_added_spans_are_learned(spark):
    r = random.Random(2)
    rows = [f"please ring +1 ({r.randrange(200, 999)}) 555-{i:04d} today" for i in range(200)] + [f"server {i % 200}.{i % 7}.0.{i % 250} is up" for i in range(200)]
    rows += [f"write to u{i}@mail.example.com soon" for i in range(200)]
    # What fails a check: short numbers, versions, handles.
    rows += [f"order {i % 90 + 10}-{i % 900 + 100}-{i % 90 + 10} shipped" for i in range(150)] + [f"version {i}.{i % 9}.1 is out" for i in range(150)] + [f"thanks user{i}@host again" for i in range(150)]
    planted = [f"please ring ({r.randrange(200, 999)}) 555-{i:04d} today" for i in range(20)]
    addresses, hosts = [f"write to u{i} (at) mail (dot) example (dot) com soon" for i in range(5)], [f"server 10[.]1[.]2[.]{i} is up" for i in range(5)]
    alike = [f"order {i % 90 + 10}-{i % 900 + 100}-{i % 90 + 11} shipped" for i in range(20)] + [f"version {i}.2.7 is out" for i in range(20)] + [f"thanks peer{i}@host again" for i in range(20)]
    groups = [*[(t, None) for t in rows], *[(t, "phone") for t in planted], *[(t, "email") for t in addresses], *[(t, "ip") for t in hosts], *[(t, "none") for t in alike]]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(groups)], "doc_id bigint, text string")
    model = pii.fit(df)
    for k, name in enumerate(pii.KINDS):
        if name != "card":
            assert model[k].positives >= 190 and model[k].negatives >= 100 and model[k].precision >= 0.95 and model[k].recall >= 0.9, name
    got = {x.doc_id: x for x in pii.find(df, model=model).select("doc_id", "base", pii.listed(F.col("all")).alias("a"), "all").collect()}
    for i, (_, kind) in enumerate(groups):
        added = [pii.KINDS[s.kind] for s in got[i].all if s not in got[i].base]
        assert added == ([kind] if kind in pii.KINDS else []), groups[i]
    text = {x.doc_id: x.text for x in pii.redact(df, model=model).collect()}
    assert text[7] == "please ring [PHONE] today" == text[len(rows)]
    trees = pii.boost([((1, 0), 90.0, 0.0), ((2, 0), 0.0, 90.0), ((3, 1), 45.0, 45.0)])
    assert pii.predict(trees, (1, 0)) > 1 and pii.predict(trees, (2, 0)) < -1


def test_calibration_has_no_switch():
    assert pii.calibrate([(1.0, 17.0, 0.0)])[0] == math.inf and pii.calibrate([(1.0, 18.0, 0.0)])[0] == 1.0
    assert pii.calibrate([(3.0, 50.0, 0.0), (2.0, 50.0, 1.0), (1.0, 0.0, 90.0)]) == (2.0, 100 / 101, 1.0)
    assert pii.calibrate([]) == (math.inf, 0.0, 0.0)


def test_quality(spark):
    r = random.Random(1)
    good, bad = ["river", "stone", "walks", "under", "light", "green"], ["WIN", "$$$", "click", "free", "!!!", "now"]
    docs, labels = [], []
    for i in range(600):
        q = i % 3 != 0
        docs.append((i, " ".join(r.choice(good if q else bad) for _ in range(r.randint(5, 40)))))
        if i % 2:
            labels.append((i, int(q), 0))
    docs += [(1000, None), (1001, ""), (None, "river stone"), docs[1]]
    d = spark.createDataFrame([(*x, "k", 0.5) for x in docs], "doc_id bigint, text string, key string, ratio double")
    lab = spark.createDataFrame([*labels, (5, None, 0), (None, 1, 0), (99999, 1, 0)], "doc_id bigint, quality int, toxic int")
    keyed, least = quality.resample(d, lab)
    got = keyed.select("doc_id", (F.col("key") >= least).alias("kept")).collect()
    assert len(got) == len(docs)
    held_out = [(x.doc_id % 3 != 0) == x.kept for x in got if x.doc_id is not None and x.doc_id < 600 and x.doc_id % 2 == 0]
    assert np.mean(held_out) > 0.9
    # By brute force: counts of features in a dictionary, and the noise of the same uniform numbers.
    target, raw = Counter(), Counter()
    label = dict((i, q) for i, q, _ in labels)
    for i, t, *_ in docs:
        ids = quality.features([t])[0].tolist()
        raw.update(ids)
        if label.get(i) == 1:
            target.update(ids)
    p = lambda c, b: math.log((c[b] + 1) / (sum(c.values()) + quality.BUCKETS))
    u = {r.doc_id: (r.h % (1 << 64) >> 11) / (1 << 53) + 0.5 / (1 << 53) for r in d.select("doc_id", F.xxhash64("doc_id", F.lit("gumbel")).alias("h")).collect()}
    want = sorted(((sum(p(target, b) - p(raw, b) for b in quality.features([t])[0].tolist()), -math.log(-math.log(u[i]))) for i, t, *_ in docs), key=sum)
    sums = sorted((r.ratio, r.key) for r in keyed.collect())
    assert np.allclose(sums, sorted((a, a + b) for a, b in want))
    seen = [label[i] for i, *_ in docs if i in label]  # a repeated row counts each time
    assert sum(x.kept for x in got) == round(np.mean(seen) * len(docs))
    assert np.allclose(sorted(r.key for r in keyed.where(F.col("key") >= least).collect()), [sum(x) for x in want[-round(np.mean(seen) * len(docs)) :]])
    cold, hot = (quality.resample(d, lab, temperature=t) for t in (1e-3, 1e3))
    assert cold[0].where((F.col("key") >= cold[1]) & (F.col("doc_id") % 3 == 0) & (F.col("doc_id") < 600)).count() < hot[0].where((F.col("key") >= hot[1]) & (F.col("doc_id") % 3 == 0) & (F.col("doc_id") < 600)).count()
    keyed, least = quality.resample(d.limit(0), lab)
    assert keyed.count() == 0
    keyed, least = quality.resample(d, lab.limit(0))
    assert keyed.where(F.col("key") >= least).count() == len(docs)


def test_kth_largest(spark):
    values = [float(x) for x in np.random.default_rng(0).normal(size=500)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    for k in (1, 17, 499, 500):
        assert df.where(F.col("v") >= quality.kth_largest(df, "v", k, 16)).count() == k
    assert quality.kth_largest(df, "v", 0) == float("inf")


def test_preference_matches_sql(spark, tmp_path):
    rows = [
        (0, 0, "system", "s"), (0, 1, "user", "q"), (0, 2, "assistant", "good"), (0, 3, "user", None), (0, 4, "assistant", "end"),
        (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "bad"), (2, 0, "user", "only"), (5, 0, None, "x"), (5, None, "assistant", ""), (4, 0, None, "x"), (4, None, "assistant", ""),
        (0, 0, "system", "s"), (6, 0, "user", "a"), (7, 0, "user", "a"), (7, 1, "assistant", "😀é"), (None, 0, "user", "z"),
    ]
    rows += [(8, k, role, text) for k, (role, text) in enumerate([("user", "a"), ("assistant", None), ("user", "b"), ("assistant", "w" * 100_000), ("user", "left open")])]
    rows += [(10, 0, "user", "a"), (10, 1, "assistant", "same"), (10, 2, "user", "b"), (10, 3, "assistant", "same")]
    turns = spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, turns string, pair_id int")
    turns.write.parquet(f"{tmp_path}/conversations.parquet")
    got = preference.op8_preference(spark, str(tmp_path)).toPandas().sort_values(["pairing", "pair_id"])
    con = duckdb.connect()
    con.execute("create table conversations (conv_id bigint, turn bigint, role varchar, text varchar)")
    con.executemany("insert into conversations values (?, ?, ?, ?)", rows)
    want = con.execute(preference.ORACLE).df().sort_values(["pairing", "pair_id"])
    for c in got.columns:
        assert [None if x is None or x != x else x for x in got[c]] == [None if x is None or x != x else x for x in want[c]], c
    reply, sibling = ({r.pair_id: r for r in got[got.pairing == k].itertuples()} for k in ("reply", "sibling"))
    assert sibling[0].prompt_turns == 2 and sibling[0].rejected == "<|im_start|>assistant\nbad<|im_end|>\n"
    spans = [tuple(map(int, s.split(":"))) for s in sibling[0].chosen_mask.split(",")]
    assert [sibling[0].chosen[a:b] for a, b in spans] == ["good<|im_end|>\n", "end<|im_end|>\n"]
    assert reply[0].prompt_turns == 4 and reply[0].rejected == "<|im_start|>assistant\ngood<|im_end|>\n" and reply[8].prompt_turns == 3 and "w" * 100_000 in reply[8].chosen
    assert reply[10].prompt_turns == 4 and reply[10].chosen == reply[10].rejected == "" and reply[2].prompt_turns == 1
    assert preference.preferences(*[spark.createDataFrame([], "pair_id bigint, turns array<struct<turn:bigint,role:string,text:string>>")] * 2).count() == 0
