"""Samplers, the pipeline of stages and the command line."""

import random
from collections import Counter
from typing import Literal

import pytest
from pyspark.sql import functions as F

from bindery import __main__ as cli
from bindery import pipeline, settings
from bindery.operators import sampling, sites

ANNOT = "annot_id bigint, seqid string, start_pos bigint, end_pos bigint, strand string, feature string"


def annots(spark):
    rows = [(k, "sA" if k < 30 else "sB", 10 + 3 * k, 40 + 3 * k, "+-"[k % 2], "gene") for k in range(40)]
    return spark.createDataFrame(rows, ANNOT)


def test_draws(spark):
    a = annots(spark)
    got = sampling.draw(a, 2000, 7)
    n = Counter(r.annot_id for r in got.collect())
    assert sum(n.values()) == 2000 and len(n) == 40 and max(n.values()) < 100
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, sampling.draw(a, 2000, 7).collect()))
    w = spark.createDataFrame([("sA", 1), ("sB", 3), ("none", 5), ("sA", 0)], "seqid string, weight bigint")
    by = Counter(r.seqid for r in sampling.draw(a, 2000, 7, w).collect())
    assert sum(by.values()) == 2000 and 0.7 < by["sB"] / 2000 < 0.8
    assert {r.seqid for r in sampling.draw_from(a, "sB", 20).collect()} == {"sB"} and sampling.draw_from(a, "sX", 20).count() == 0


def test_random_sequences(spark):
    r = random.Random(1)
    text = {"sA": "".join(r.choice("ACGT") for _ in range(150)), "sB": "".join(r.choice("ACGTN") if k % 9 else "N" for k in range(300))}
    genome = spark.createDataFrame(list(text.items()), "seqid string, seq string")
    got = sampling.random_sequences(annots(spark), genome, 50, 3, 5).collect()
    assert len(got) == 50 and len({x.draw for x in got}) == 50
    flip = str.maketrans("ACGT", "TGCA")
    for x in got:
        s = text[x.seqid][x.position - 4 : x.position + 3]
        assert x.seq == (s[::-1].translate(flip) if x.strand == "-" else s) and "N" not in x.seq
    s = spark.createDataFrame([("sA", 5)] * 9 + [("sX", 1)], "seqid string, position bigint")
    assert {x.seqid for x in sampling.negative_set(s, annots(spark), genome, 20, 2).collect()} == {"sA"}
    assert sampling.negative_lines(sampling.negative_set(s, annots(spark), genome, 3, 2)).first().value.startswith(">random:")


def some_stage(spark, t, *, a: settings.Count, b: bool = True, c: settings.Base = "T", d: Literal["x", "y"] = "x", e: list[str] = (), f: settings.Amount = 0.5, g: settings.MaybeDna = ""):
    return {}


def test_settings():
    known = settings.fields(some_stage)
    rest = {"d": "x", "e": [], "f": 0.5, "g": ""}
    assert settings.read({"a": "3", "b": "no", "c": "u"}, known) == {"a": 3, "b": False, "c": "T"} | rest
    assert settings.read({"a": 0}, known) == {"a": 0, "b": True, "c": "T"} | rest
    assert settings.read({"a": 1, "d": "y", "e": "p, q,", "f": "2", "g": "acu"}, known) == {"a": 1, "b": True, "c": "T", "d": "y", "e": ["p", "q"], "f": 2.0, "g": "ACT"}
    for bad in ({}, {"a": -1}, {"a": "x"}, {"a": 1.5}, {"a": 1, "c": "AC"}, {"a": 1, "z": 2}, {"a": 1, "b": "perhaps"}, {"a": 1, "d": "z"}, {"a": 1, "f": "nan"}, {"a": 1, "g": "AXC"}):
        with pytest.raises(settings.ConfigError):
            settings.read(bad, known)
    with pytest.raises(settings.ConfigError, match="'a'.*'c'"):
        settings.read({"a": -1, "c": ""}, known)
    assert pipeline.beside("/x/c.yaml", "d") == "/x/d" == pipeline.beside("/y/c", "/x/d")


def test_plans_are_checked():
    ok = pipeline.plan({"inputs": {"pileup": "p", "gff": "g"}, "stages": ["naive_finder", {"gff_filter": {"features": "tRNA", "padding": 5}}, {"annotate": {"skip": "yes"}}]})
    assert [s.name for s, _ in ok.jobs] == ["naive_finder", "gff_filter"]
    for bad in ({"stages": ["annotate"]}, {"inputs": {"what": "p"}}, {"stages": ["nothing"]}, {"stages": ["json.loads"]}, {"inputs": {"pileup": "p"}, "stages": [{"naive_finder": {"typo": 1}}]}, {"custom_files": {"x": {"reader": "y", "path": "z"}}}):
        with pytest.raises(pipeline.ConfigError):
            pipeline.plan(bad)


OWN = pipeline.Stage("own", lambda spark, t: {"sites": t["sites"].where("transitions > 2")}, ("sites",), ("sites",))


def inputs(tmp_path):
    r = random.Random(9)
    rows, mock = [], []
    for k in range(1, 400):
        ref = "ACGT"[k % 4]
        rows.append(f"c1\t{k}\t{ref}\t9\t{'.' * r.randint(0, 9)}{'C' * r.randint(0, 4)}{',' * r.randint(0, 9)}{'g' * r.randint(0, 4)}\tI")
        mock.append(f"c1\t{k}\t{ref}\t9\t{'.' * r.randint(0, 9)}{'C' * r.randint(0, 2)}{',' * r.randint(0, 9)}{'g' * r.randint(0, 2)}\tI")
    (tmp_path / "p").write_text("\n".join(rows) + "\n")
    (tmp_path / "m").write_text("\n".join(mock) + "\n")
    (tmp_path / "g.gff").write_text("".join(f"c1\ts\t{t}\t{a}\t{a + 40}\t.\t{d}\t.\tID=x{a}\n" for a, t, d in ((10, "gene", "+"), (60, "tRNA", "-"), (150, "gene", "-"), (220, "gene", "+"), (300, "exon", "+"))))
    (tmp_path / "g.fa").write_text(">c1\n" + "\n".join("".join("ACGT"[(60 * i + j + 1) % 4] for j in range(60)) for i in range(7)) + "\n")


CONFIG = """
inputs: {pileup: p, mock_pileup: m, gff: g.gff, genome: g.fa}
stages:
  - pileup_counts
  - mock_counts
  - prediction_sites
  - transition_table
  - learn_mock: {coverage: 2.0, iterations: 20}
  - mock_finder: {coverage: 3.0, posterior: 0.0, min_k: 1}
  - naive_finder: {min_transitions: ${least}}
  - tests.test_layers.OWN
  - normalize
  - quantile_cap: {quantile: 0.9}
  - gff_filter: {features: tRNA}
  - annotate
  - motif_sequences: {width: 3, end: 20}
  - negative_set: {n: 20, width: 3}
  - kmer_log_odds: {k: 2, width: 3, bin: 10}
  - kmer_positions: {k: 2, width: 3}
  - metagene: {upstream: 5, downstream: 5, gene: 3, smooth: 3}
  - bootstrap: {upstream: 5, gene: 3, draws: 5}
  - heatmap: {xbins: 4, ybins: 2}
  - transition_frequency
"""


def test_pipeline_runs(spark, tmp_path):
    inputs(tmp_path)
    (tmp_path / "c.yaml").write_text(CONFIG)
    config = pipeline.load(f"{tmp_path}/c.yaml", {"least": "2"})
    with pytest.raises(pipeline.ConfigError):
        pipeline.load(f"{tmp_path}/c.yaml")
    t = pipeline.run(spark, config, f"{tmp_path}/c.yaml")
    kept = t["sites"].collect()
    assert kept and all(r.transitions > 2 and r.occupancy is not None for r in kept)
    assert not [r for r in kept if r.strand == "-" and 60 <= r.position <= 100]
    named = t["annotated"].collect()
    assert len(named) == len(kept) and {r.annotation for r in named} <= {"NA", "gene", "exon"}
    assert t["posteriors"].count() > 0 and t["metagene"].count() == 18 and t["confidence"].count() == 9
    lines = [r.value for r in t["fasta"].collect()]
    assert lines and all(x.startswith(">seq:") and len(x.split("\n")[1]) == 7 for x in lines)
    assert t["negatives"].count() == 20 and t["kmer_log_odds"].count() % 16 == 0
    for f in ("kmer_positions", "heatmap", "transitions", "annotation_summary", "bootstrap"):
        assert t[f].count() > 0, f


def test_command_line(spark, tmp_path, capsys):
    inputs(tmp_path)
    assert cli.main(["stages"]) == 0 and "naive_finder: pileup -> sites" in capsys.readouterr().out
    assert cli.main(["stage", "annotate", "--out", "x", "--check"]) == 1 and "nothing gives" in capsys.readouterr().err
    assert cli.main(["stage", "naive_finder", "--input", f"pileup={tmp_path}/p", "--set", "min_transitions=3", "--out", f"{tmp_path}/out"]) == 0
    back = spark.read.parquet(f"{tmp_path}/out/sites")
    assert back.count() > 0 and back.agg(F.min("transitions")).first()[0] == 3
    (tmp_path / "c.yaml").write_text("inputs: {pileup: p}\nstages: [pileup_counts, {background_finder: {max_p: 0.5}}]\n")
    assert cli.main(["run", f"{tmp_path}/c.yaml", "--out", f"{tmp_path}/two"]) == 0
    assert sites.sliced(spark.read.parquet(f"{tmp_path}/two/sites"), [F.col("position")], 0, 1).count() == 1


def test_reads_to_sites(spark, tmp_path):
    """Raw reads through trimming, and alignments through deduplication, order and pileup, to counts."""
    adapter = "TGGAATTCTCGGGTGCCAAGG"
    fastq = [("r1 x", "ACGTTT" + "GATTACA" * 4 + adapter[:12], "I" * 46), ("r2", "ACGTTT" + "GATTACA" * 4 + "TGGAATACTC", "I" * 30 + "#" * 14), ("r3", "ACG", "III")]
    (tmp_path / "r.fq").write_text("".join(f"@{i}\n{s}\n+\n{q}\n" for i, s, q in fastq))
    clean = pipeline.run(spark, {"inputs": {"fastq": f"{tmp_path}/r.fq"}, "stages": [{"clip_tolerant": {"adapter3": adapter, "min_length": 5}}, {"quality_trim": {"cutoff": 20}}, {"umi_extract": {"length": 6}}]})
    assert sorted((x.id, x.seq) for x in clean["fastq"].collect()) == [("r1_ACGTTT x", "GATTACA" * 4), ("r2_ACGTTT", ("GATTACA" * 4)[:24])]
    sam = [f"r{k}_{'ACGT'[k % 2] * 4}\t{16 * (k % 3 == 2)}\tc1\t{5 + k % 3}\t{k}\t4M\t*\t0\t0\tACGT\tIIII" for k in range(12)]
    (tmp_path / "a.sam").write_text("@HD\tVN:1.6\n" + "\n".join(sam) + "\nu\t4\t*\t0\t0\t*\t*\t0\t0\tAC\tII\n")
    (tmp_path / "g.fa").write_text(">c1\nTTTTACGTTACG\n")
    t = pipeline.run(spark, {"inputs": {"sam": f"{tmp_path}/a.sam", "genome": f"{tmp_path}/g.fa"}, "stages": ["umi_deduplicate", {"sort_alignments": {"partitions": 2}}, "pileup", "pileup_counts"]})
    assert t["molecules"].count() == 6 and t["sam"].columns[-1] == "end_pos"
    # The best of each place and identifier: the last ones, by mapping quality.
    assert sorted(x.read_id for x in t["sam"].collect()) == sorted(f"r{k}_{'ACGT'[k % 2] * 4}" for k in range(6, 12))
    rows = {x.pos: (x.ref, x.depth, x.bases) for x in t["pileup"].collect()}
    assert rows[5] == ("A", 2, "^'.^*.") and sum(d for _, d, _ in rows.values()) == 24
    assert t["counts"].count() > 0


def test_inputs_are_checked_before_stages_run(spark, tmp_path):
    inputs(tmp_path)
    with pytest.raises(pipeline.ConfigError, match="pileup: .*nothing"):
        pipeline.run(spark, {"inputs": {"pileup": f"{tmp_path}/nothing"}, "stages": ["pileup_counts"]})
    (tmp_path / "g.fa.fai").write_text("c1\t420\t4\t60\t61\n")
    good = {"inputs": {"genome": f"{tmp_path}/g.fa", "genome_index": f"{tmp_path}/g.fa.fai"}, "stages": ["prediction_sites"]}
    assert pipeline.run(spark, good)["universe"].count() > 0
    (tmp_path / "g.fa.fai").write_text("c1\t421\t4\t60\t61\n")
    with pytest.raises(pipeline.ConfigError, match="c1"):
        pipeline.run(spark, good)
