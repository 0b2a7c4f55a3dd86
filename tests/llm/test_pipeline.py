import corpus_pipeline
from bindery.llm.common import one_space


def test_stages(spark, tmp_path):
    good = [(i, f"doc {i} " + " ".join(f"w{(i * 31 + j * j) % 977}" for j in range(60)), "en", "s", 1) for i in range(40)]
    bad = [(100 + i, " ".join(["BUY!!"] * 30 + [f"x{i}"]), "en", "s", 1) for i in range(20)]
    rows = [*good, *bad, (200, good[0][1].replace(" ", "  "), "en", "s", 1), (201, good[1][1] + " mail me@host.example.com", "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 100), 0) for i in [*range(30), *range(100, 115)]], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), {}
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        d = stage(spark, d, str(tmp_path))
        assert k == 4 or d.columns == docs.columns
        d.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
        seen[name] = d.collect()
    # The share of good labels is two thirds, by which the sample takes 41 of 62 rows: all that it takes are good.
    kept = {r.doc_id for r in seen["quality"]}
    assert len(kept) == 41 and kept <= {r[0] for r in rows if r[0] < 100 or r[0] >= 200}
    assert len({one_space(r.text) for r in seen["exact_dedup"]}) == len(seen["exact_dedup"]) == len({one_space(r.text) for r in seen["quality"]})
    assert "me@host" not in " ".join(r.text for r in seen["pii"])
    assert {r.doc_id for r in seen["packing"]} == {r.doc_id for r in seen["pii"]}
    ran = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.ids_crc32, r.length) for r in ran} == {(r.doc_id, r.ids_crc32, r.length) for r in seen["packing"]}


ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, ratio double, name string, base int, all string, spans int, node string, _id string, more int"


def test_odd_rows_and_columns(spark, tmp_path):
    own = ("k", 0.5, "n", 7, "a", 8, "x", "y", 9)
    good = [(i, f"text {i} " + " ".join(f"v{(i * 37 + j * j) % 991}" for j in range(50))) for i in range(30)]
    rows = [*good, good[3], good[3], (40, None), (41, ""), (42, " \n "), (None, good[4][1]), (None, "alone with a@b.example.com"), (43, "v1 " * 30_000), (44, good[5][1].upper()), (45, None)]
    docs = spark.createDataFrame([(*r, "en", "s", len(r[1] or ""), *own) for r in rows], ODD)
    spark.createDataFrame([], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    d = docs
    for name, stage in corpus_pipeline.STAGES[:4]:
        d = stage(spark, d, str(tmp_path))
        d.write.parquet(f"{tmp_path}/{name}")
        d = spark.read.parquet(f"{tmp_path}/{name}")
        assert d.columns == docs.columns
        assert {tuple(r)[5:] for r in d.collect()} == {own}, name
    left = {(r.doc_id, r.text) for r in d.collect()}
    assert left == {*good, (40, None), (None, "alone with [EMAIL]"), (43, "v1 " * 30_000), (42, " \n ")} or left == {*good, (40, None), (None, "alone with [EMAIL]"), (43, "v1 " * 30_000)}
    pieces = corpus_pipeline.pack(spark, d, str(tmp_path)).collect()
    assert {p.doc_id for p in pieces} == {r[0] for r in left} and max(p.offset + p.length for p in pieces) <= 4096


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], ODD)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id bigint, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns and out.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
