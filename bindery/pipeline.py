"""Pipelines of stages over named DataFrames, checked before anything runs.

A stage takes tables by format (reads, pileup, sites, ...) and gives tables by format; a pipeline resolves its stages,
validates their settings and the formats they need, and then chains them. Nothing is written between stages:
the whole pipeline is one plan, but for the fits that a model needs.
"""

from __future__ import annotations

import importlib
import os
import string
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from typing import Any, Literal

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindery import settings
from bindery.functions import sequences
from bindery.operators import alignments, background, kmers, lineage, models, pileup, profiles, reads, sampling, sites, trimming, umis
from bindery.settings import Amount, Base, ConfigError, Count, Dna, MaybeDna
from bindery.sources import bam, tables

Frames = dict[str, Any]


def beside(config_path: str, path: str) -> str:
    """A path as it is if it is absolute or names a store, else relative to the configuration file."""
    return path if os.path.isabs(path) or "://" in path else os.path.join(os.path.dirname(os.path.abspath(config_path)), path)


@dataclass(frozen=True)
class Stage:
    """run(spark, tables, **settings) gives the tables that it makes; its keyword-only arguments are the settings."""

    name: str
    run: Callable[..., Frames]
    needs: tuple[str, ...]
    gives: tuple[str, ...]

    @property
    def settings(self) -> dict[str, Any]:
        return settings.fields(self.run)


STAGES: dict[str, Stage] = {}


def stage(name: str, needs: tuple[str, ...], gives: tuple[str, ...]):
    """Registers a stage; other packages may add theirs, or name one by its dotted path."""

    def add(f: Callable[..., Frames]):
        STAGES[name] = Stage(name, f, needs, gives)
        return f

    return add


def _common(*, skip: bool = False, module_info: str = "") -> None:
    """What every stage takes: whether to leave it out, and a note."""


def resolve(name: str) -> Stage:
    if name in STAGES:
        return STAGES[name]
    module, _, attribute = name.rpartition(".")
    try:
        found = getattr(importlib.import_module(module), attribute) if module else None
    except (ImportError, AttributeError) as e:
        raise ConfigError(f"no stage {name!r}: {e}") from e
    if not isinstance(found, Stage):
        raise ConfigError(f"no stage {name!r}")
    return found


@dataclass
class Pipeline:
    """Stages with their settings, in order. Checked when they are scheduled."""

    formats: set[str]
    jobs: list[tuple[Stage, dict[str, Any]]] = field(default_factory=list)

    def schedule(self, name: str, config: Mapping[str, Any] | None = None) -> None:
        s = resolve(name)
        given = settings.read(config or {}, s.settings | settings.fields(_common), name)
        if given["skip"]:
            return
        if missing := [f for f in s.needs if f not in self.formats]:
            raise ConfigError(f"{name}: nothing gives {', '.join(missing)}")
        self.formats |= set(s.gives)
        self.jobs.append((s, {k: v for k, v in given.items() if k in s.settings}))

    def run(self, spark: SparkSession, frames: Frames) -> Frames:
        frames = dict(frames)
        for s, given in self.jobs:
            frames |= s.run(spark, frames, **given)
        return frames


#: Format -> reader of a path.
READERS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "fastq": tables.read_fastq, "sam": tables.read_sam, "later_sam": tables.read_sam, "bam": bam.read_bam, "pileup": tables.read_pileup, "mock_pileup": tables.read_pileup, "sites": tables.read_sites, "legacy_sites": tables.read_legacy,
    "gff": lambda spark, path: with_ids(tables.read_gff(spark, path)), "genome": tables.read_fasta, "genome_index": tables.read_fai, "parquet": lambda spark, path: spark.read.parquet(path),
}


def with_ids(gff: DataFrame) -> DataFrame:
    """Annotations as the operators take them: `feature` is the type, annot_id a number that follows from the row."""
    return gff.select(F.xxhash64(*[F.col(c) for c in ("seqid", "type", "start_pos", "end_pos", "strand")], F.to_json("attributes")).alias("annot_id"), "seqid", "start_pos", "end_pos", "strand", F.col("type").alias("feature"))


def load(path: str, variables: Mapping[str, str] | None = None) -> dict[str, Any]:
    """A YAML file whose ${name} are replaced by variables; an unknown one raises."""
    import yaml

    with open(path, encoding="utf-8") as f:
        try:
            return yaml.safe_load(string.Template(f.read()).substitute(variables or {})) or {}
        except KeyError as e:
            raise ConfigError(f"{path}: no value for ${{{e.args[0]}}}") from e


def _custom(*, path: str, reader: str = "parquet") -> None:
    """What a custom file takes."""


def plan(config: Mapping[str, Any]) -> Pipeline:
    """inputs: {format: path}, custom_files: {format: {path, reader}}, stages: [name or {name: settings}]."""
    inputs = dict(config.get("inputs") or {})
    for fmt, c in (config.get("custom_files") or {}).items():
        if settings.read(c, settings.fields(_custom), f"custom_files.{fmt}")["reader"] not in READERS:
            raise ConfigError(f"custom_files.{fmt}: one of {', '.join(READERS)} is expected")
    if unknown := [f for f in inputs if f not in READERS]:
        raise ConfigError(f"inputs: no reader for {', '.join(unknown)}")
    p = Pipeline(set(inputs) | set(config.get("custom_files") or {}))
    for s in config.get("stages") or []:
        name, given = (s, {}) if isinstance(s, str) else next(iter(s.items()))
        p.schedule(name, given)
    return p


def run(spark: SparkSession, config: Mapping[str, Any], config_path: str = ".") -> Frames:
    """The tables of all formats at the end of a pipeline, not yet computed."""
    p = plan(config)
    wanted = {f: (f, path) for f, path in (config.get("inputs") or {}).items()}
    wanted |= {f: (c.get("reader", "parquet"), c["path"]) for f, c in (config.get("custom_files") or {}).items()}
    frames: Frames = {}
    for fmt, (reader, path) in wanted.items():
        try:
            frames[fmt] = READERS[reader](spark, beside(config_path, path))
        except AnalysisException as e:  # Spark looks paths up when a table is made
            raise ConfigError(f"{fmt}: {path} cannot be read: {e.getCondition() or e}") from e
    if "genome" in frames and "genome_index" in frames:
        lengths = frames["genome"].select("seqid", F.lit(1).alias("chunk_start"), "seq")
        if wrong := tables.check_index(lengths, frames["genome_index"]).limit(5).collect():
            raise ConfigError(f"genome_index: it does not fit the genome at {', '.join(r['seqid'] for r in wrong)}")
    return p.run(spark, frames)


# --- stages ------------------------------------------------------------------------------------------------

@stage("deduplicate", ("fastq",), ("fastq",))
def _deduplicate(spark, t):
    return {"fastq": reads.deduplicate(t["fastq"], "id")}


@stage("clip_adapters", ("fastq",), ("fastq",))
def _clip(spark, t, *, adapter5: MaybeDna = "", adapter3: MaybeDna = "", barcode5: Count = 0, barcode3: Count = 0, min_length: Count = 20):
    s, q = sequences.clip_adapters(F.col("seq"), F.col("qual"), adapter5, adapter3, barcode5, barcode3)
    return {"fastq": t["fastq"].withColumns({"seq": s, "qual": q}).where(F.length("seq") >= min_length)}


@stage("remove_five", ("fastq",), ("fastq",))
def _remove_five(spark, t, *, adapter: Dna, seed: Count = 3, mode: Literal["strict", "seeded", "anywhere"] = "seeded"):
    left = sequences.remove_five(F.col("seq"), adapter, seed, mode)
    return {"fastq": t["fastq"].withColumn("_s", left).withColumn("qual", F.expr("substring(qual, length(seq) - length(_s) + 1, length(_s))")).withColumn("seq", F.col("_s")).drop("_s")}


@stage("clip_tolerant", ("fastq",), ("fastq",))
def _clip_tolerant(spark, t, *, adapter3: Dna, error_rate: Amount = 0.1, overlap: Count = 3, min_length: Count = 20):
    return {"fastq": trimming.clip_tolerant(t["fastq"], adapter3, error_rate, overlap, min_length)}


@stage("quality_trim", ("fastq",), ("fastq",))
def _quality_trim(spark, t, *, cutoff: Count = 30, min_length: Count = 20, mode: Literal["end", "sum", "segment"] = "end", phred_base: Count = 33):
    return {"fastq": trimming.trim_quality(t["fastq"], cutoff, min_length, mode, phred_base)}


@stage("umi_extract", ("fastq",), ("fastq",))
def _umi_extract(spark, t, *, length: Count):
    return {"fastq": umis.extract(t["fastq"], length).drop("umi")}


@stage("umi_deduplicate", ("sam",), ("sam", "molecules"))
def _umi_deduplicate(spark, t):
    kept = umis.deduplicate(t["sam"])
    return {"sam": kept.select(t["sam"].columns), "molecules": kept.select("read_id", "umi", "molecule_reads", "molecule_umis")}


@stage("left_over", ("fastq", "sam"), ("fastq",))
def _left_over(spark, t):
    return {"fastq": reads.left_over(t["fastq"], t["sam"])}


@stage("merge_runs", ("sam", "later_sam"), ("sam",))
def _merge_runs(spark, t):
    return {"sam": reads.merge_runs(t["sam"], t["later_sam"])}


@stage("sort_alignments", ("sam",), ("sam",))
def _sort_alignments(spark, t, *, partitions: Count = 200):
    path = lineage.new_table(spark, "sorted")
    alignments.write_sorted(t["sam"], path, partitions)
    return {"sam": spark.read.parquet(path)}


@stage("pileup", ("sam", "genome"), ("pileup",))
def _pileup(spark, t):
    return {"pileup": alignments.pileup(t["sam"], t["genome"])}


@stage("read_filter", ("sam",), ("sam", "read_qc"))
def _read_filter(spark, t, *, min_quality: Count = 0, min_mean_quality: Amount = 20.0, min_length: Count = 20, max_mismatches: Count = 1, edge: Count = 2):
    how = (min_quality, min_mean_quality, min_length)
    good = t["sam"].where(reads.drop_reason(*how).isNull())
    return {"sam": reads.clip_edges(reads.mismatch_filter(good, min_quality, max_mismatches, edge), edge), "read_qc": reads.read_qc(t["sam"], *how)}


@stage("bam_statistics", ("sam",), ("statistics",))
def _statistics(spark, t):
    return {"statistics": reads.statistics(t["sam"])}


@stage("softclip_analysis", ("sam",), ("softclips",))
def _softclips(spark, t, *, top: Count = 10):
    return {"softclips": reads.softclips(t["sam"], top)}


@stage("pileup_counts", ("pileup",), ("counts",))
def _counts(spark, t, *, reference: Base = "T", mutation: Base = "C"):
    return {"counts": pileup.counts(t["pileup"], (reference, mutation))}


@stage("mock_counts", ("mock_pileup",), ("mock_counts",))
def _mock_counts(spark, t, *, reference: Base = "T", mutation: Base = "C"):
    return {"mock_counts": pileup.counts(t["mock_pileup"], (reference, mutation))}


@stage("transition_frequency", ("pileup",), ("transitions",))
def _frequency(spark, t, *, min_coverage: Count = 5):
    return {"transitions": pileup.transition_probabilities(pileup.transition_matrix(t["pileup"], min_coverage))}


@stage("naive_finder", ("pileup",), ("sites",))
def _naive(spark, t, *, min_transitions: Count = 2, reference: Base = "T", mutation: Base = "C"):
    return {"sites": pileup.naive_sites(t["pileup"], min_transitions, reference, mutation)}


@stage("background_finder", ("counts",), ("sites",))
def _background(spark, t, *, min_coverage: Count = 5, max_p: Amount = 0.001, restarts: Count = 100, average: Literal["best", "running"] = "best"):
    fitted = background.fit(t["counts"], restarts=restarts, average=average)
    return {"sites": models.call_sites(t["counts"], fitted, min_coverage, max_p, models.snp_likely(fitted))}


@stage("prediction_sites", ("genome",), ("universe",))
def _universe(spark, t, *, nucleotide: Base = "T"):
    return {"universe": pileup.site_universe(t["genome"], nucleotide).select(F.col("seqid").alias("chrom"), "pos", "strand")}


@stage("transition_table", ("universe", "counts", "mock_counts"), ("transition_table",))
def _transition_table(spark, t):
    return {"transition_table": sites.merge_counts(t["universe"], t["counts"], t["mock_counts"])}


@stage("learn_mock", ("mock_counts",), ("mock_model",))
def _learn(spark, t, *, coverage: float, components: Count = 3, iterations: Count = 250):
    return {"mock_model": models.fit_mock(t["mock_counts"], coverage, components, iterations)}


@stage("mock_finder", ("transition_table", "mock_model"), ("posteriors", "sites"))
def _mock_finder(spark, t, *, coverage: float, max_k_mock: Count = 10, posterior: Amount = 0.1, min_k: Count = 2, scale: bool = False):
    post = models.score_with(t["transition_table"], t["mock_model"], coverage, max_k_mock, scale)
    return {"posteriors": post, "sites": models.posterior_sites(post, posterior, min_k)}


@stage("normalize", ("sites", "mock_counts"), ("sites",))
def _normalize(spark, t, *, max_ratio: Amount = 0.0):
    other = t["mock_counts"].select(F.col("chrom").alias("seqid"), F.col("pos").alias("position"), "strand", F.col("n").alias("total"), F.col("k").alias("mutated"))
    return {"sites": sites.normalize(t["sites"], other, max_ratio or None)}


@stage("quantile_cap", ("sites",), ("sites",))
def _cap(spark, t, *, column: str = "occupancy", quantile: Amount = 0.95):
    return {"sites": sites.cap_at_quantile(t["sites"], column, quantile)}


@stage("upgrade", ("legacy_sites",), ("sites",))
def _upgrade(spark, t):
    return {"sites": sites.upgrade_legacy(t["legacy_sites"])}


@stage("gff_filter", ("sites", "gff"), ("sites",))
def _gff_filter(spark, t, *, features: list[str] = (), padding: Count = 0, ignore_seqid: bool = False):
    return {"sites": sites.filter_features(t["sites"], t["gff"], features, padding, ignore_seqid)}


@stage("annotate", ("sites", "gff"), ("annotated", "annotation_summary"))
def _annotate(spark, t, *, max_n: Count = 0):
    found = sites.annotate(t["sites"], t["gff"], t["sites"].columns, max_n or None)
    return {"annotated": found, "annotation_summary": sites.annotation_summary(found)}


@stage("motif_sequences", ("sites", "gff", "genome"), ("fasta",))
def _motif(spark, t, *, features: list[str] = (), padding: Count = 20, key: str = "occupancy", begin: Count = 0, end: Count = 1000, width: Count = 12):
    """Unwanted features removed, a slice of the best sites, and their sequences as FASTA lines with their place."""
    rest = sites.filter_features(t["sites"], t["gff"], features, padding)
    order = [F.col(key).desc_nulls_last(), *[F.col(c) for c in ("seqid", "position", "strand")]]
    best = sites.sliced(rest, order, begin, end)
    # At most end - begin rows, which one array numbers.
    fields = F.struct(F.col(key).isNull().alias("_no"), (-F.col(key).cast("double")).alias("_k"), "seqid", "position", "strand", F.struct(*best.columns).alias("_row"))
    numbered = best.agg(F.sort_array(F.collect_list(fields)).alias("_all")).select(F.posexplode("_all").alias("ordinal", "_r")).select("ordinal", "_r._row.*")
    return {"fasta": tables.fasta_lines(kmers.windows(numbered, t["genome"], width, keep=True)).orderBy("rank")}


@stage("negative_set", ("sites", "gff", "genome"), ("negatives",))
def _negatives(spark, t, *, n: Count = 1000, width: Count = 20, seed: int = 42, by_site: bool = True):
    if by_site:
        return {"negatives": sampling.negative_set(t["sites"], t["gff"], t["genome"], n, width, seed)}
    return {"negatives": sampling.random_sequences(t["gff"], t["genome"], n, width, seed)}


@stage("kmer_log_odds", ("sites", "genome", "negatives"), ("kmer_log_odds",))
def _log_odds(spark, t, *, k: Count = 3, width: Count = 20, bin: Count = 1000, most: Count = 50000):
    """Bins of ranks by occupancy, against the k-mers of the negative set."""
    scored = t["sites"].where("occupancy is not null").withColumns({"_o": -F.round(F.col("occupancy") * 1_000_000_000).cast("long"), "_h": F.xxhash64("seqid", "position", "strand").bitwiseAND((1 << 52) - 1)})
    ranked = sites.ordinal(scored, "_o", "_h").withColumnRenamed("ordinal", "rank")
    binned = kmers.rank_bins(kmers.windows(ranked, t["genome"], width), bin, most)
    background = kmers.frequencies(kmers.count(t["negatives"], k, 1))
    return {"kmer_log_odds": kmers.log_odds(binned.select("bin", "seq"), background, k)}


@stage("kmer_positions", ("sites", "genome"), ("kmer_positions",))
def _positions(spark, t, *, k: Count = 3, width: Count = 20):
    return {"kmer_positions": kmers.by_position(kmers.windows(t["sites"], t["genome"], width), k, True, 2 * width + 2 - k)}


@stage("metagene", ("sites", "gff"), ("metagene",))
def _metagene(spark, t, *, upstream: Count = 1000, downstream: Count = 1000, gene: Count = 750, smooth: Count = 20, min_size: Count = 1, max_size: Count = 1 << 40, antisense: bool = False):
    size = F.col("end_pos") - F.col("start_pos") + 1
    annots = t["gff"].where(size.between(min_size, max_size))
    return {"metagene": profiles.metagene(t["sites"], annots, upstream, downstream, gene, smooth, not antisense)}


@stage("bootstrap", ("sites", "gff"), ("bootstrap", "confidence"))
def _bootstrap(spark, t, *, upstream: Count = 1000, gene: Count = 750, draws: Count = 500, seed: int = 42):
    draws = profiles.bootstrap_exact(t["sites"], t["gff"], upstream, gene, draws, seed)
    return {"bootstrap": draws, "confidence": profiles.interval_of(draws)}


@stage("heatmap", ("sites", "gff"), ("heatmap",))
def _heatmap(spark, t, *, xbins: Count = 500, ybins: Count = 500, scaled: bool = False):
    sized = sites.ordinal(t["gff"].withColumns({"_size": F.col("end_pos") - F.col("start_pos"), "_h": F.col("annot_id").bitwiseAND((1 << 52) - 1)}), "_size", "_h").drop("_size", "_h")
    return {"heatmap": profiles.heatmap(t["sites"], sized, xbins, ybins, scaled)}
