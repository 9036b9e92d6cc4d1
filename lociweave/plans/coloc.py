"""The whole run: credible sets and statistics in, released table out.

Three tables are written on the way, the same ones a run would want to keep: the
overlaps, the reduced statistics and the raw results. Between them the plan is lazy.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lociweave.config import Config
from lociweave.operators import manifest as M
from lociweave.operators.abf import PAIR, coloc_abf
from lociweave.operators.audit import CountedWrites, run_failures
from lociweave.operators.conditional import reduced_sumstats
from lociweave.operators.overlap import attach_signals, overlap_table
from lociweave.operators.process import process_results
from lociweave.schemas import COLOC_KEYS, COLOC_STATS, SIGNAL, SIGNAL_TO_COLOC
from lociweave.session import Scratch, materialise
from lociweave.sources import readers, writers


@dataclass
class Inputs:
    credset: DataFrame
    sumstats: DataFrame
    top_loci: DataFrame
    gene_lut: DataFrame
    panel: DataFrame | None = None
    previous: DataFrame | None = None
    custom_studies: DataFrame | None = None
    n_samples: int | None = None
    # statistics that an earlier run has already reduced, by signal id
    reduced: DataFrame | None = None


@dataclass
class Outputs:
    overlap: DataFrame
    manifest: DataFrame
    reduced: DataFrame
    coloc_raw: DataFrame
    coloc_processed: DataFrame
    failures: DataFrame


def build_manifest(overlap: DataFrame, inputs: Inputs, config: Config) -> DataFrame:
    chosen = M.filter_custom_studies(overlap, inputs.custom_studies)
    chosen = M.filter_overlap_prop(chosen, config.min_overlap_prop)
    chosen = M.filter_credset_size(chosen, config.max_credset_size)
    manifest = M.manifest_build(chosen, config.method, config.no_ld_prefix)
    return M.manifest_anti_previous(manifest, inputs.previous)


def pending(signals: DataFrame, reduced: DataFrame) -> DataFrame:
    """Signals without reduced statistics yet."""
    return signals.join(reduced.select("sid").distinct(), "sid", "left_anti")


def raw_results(posteriors: DataFrame, signals: DataFrame) -> DataFrame:
    """Posteriors per pair of signal ids as the raw result table."""
    wide = attach_signals(posteriors, signals, SIGNAL)
    names = {f"{s}_{old}": f"{s}_{new}" for s in ("left", "right") for old, new in SIGNAL_TO_COLOC.items()}
    return wide.withColumnsRenamed(names).select(*COLOC_STATS, *COLOC_KEYS)


def run(
    inputs: Inputs,
    config: Config = Config(),
    keep: Callable[[DataFrame, str], DataFrame] = materialise,
    digits: int | None = None,
) -> Outputs:
    """All stages. ``keep`` stores the intermediate tables. ``digits``: decimals to which raw
    posteriors are rounded, so that ties between tests do not hang on the order of sums."""
    overlap = keep(
        overlap_table(
            inputs.credset,
            config.which_set,
            config.which_method,
            config.max_lead_distance,
            with_ids=True,
        ),
        "overlap",
    )
    manifest = build_manifest(overlap, inputs, config)
    signals = keep(M.distinct_signals(manifest), "signals")
    todo = signals if inputs.reduced is None else pending(signals, inputs.reduced)
    fresh = keep(
        reduced_sumstats(
            todo,
            inputs.sumstats,
            inputs.top_loci,
            inputs.panel,
            config.window_coloc_kb,
            config.window_cond_kb,
            config.min_maf,
            config.method,
            config.max_collinearity,
            n_samples=inputs.n_samples,
            keep=keep,
        ),
        "reduced",
    )
    reduced = fresh if inputs.reduced is None else fresh.unionByName(inputs.reduced.select(*fresh.columns))
    # stored, as the failures are told from it as well
    tested = keep(
        coloc_abf(manifest.select(*PAIR), reduced, config.p1, config.p2, config.p12, keep=keep), "tested"
    )
    raw = raw_results(tested, signals)
    if digits is not None:
        raw = raw.withColumns({c: F.round(c, digits) for c in COLOC_STATS if c != "coloc_n_vars"})
    raw = keep(raw, "coloc_raw")
    failures = run_failures(signals, manifest, reduced, tested)
    return Outputs(
        overlap, manifest, reduced, raw, process_results(raw, inputs.gene_lut, config), failures
    )


def read_inputs(spark: SparkSession, config: Config) -> Inputs:
    optional = lambda path, read: read(spark, path) if path else None
    return Inputs(
        credset=readers.scan_credset(spark, config.credset),
        sumstats=readers.scan_sumstats_table(spark, config.sumstats),
        top_loci=readers.scan_top_loci(spark, config.top_loci),
        gene_lut=readers.scan_gene_lut(spark, config.gene_lut),
        panel=optional(config.ld_reference, lambda s, p: s.read.parquet(p)),
        previous=optional(config.coloc_table, lambda s, p: s.read.parquet(p)),
        custom_studies=optional(
            config.custom_studies,
            lambda s, p: readers.scan_parquet_projected(s, p, ["study_id"]),
        ),
        n_samples=config.n_samples,
        reduced=optional(config.reduced, lambda s, p: s.read.parquet(p)),
    )


def run_files(spark: SparkSession, config: Config) -> Outputs:
    """A run from the configured paths; results are written below ``config.output``.

    The reduced statistics are written too: given as ``config.reduced``, a later run skips their
    signals. ``failures`` lists what could not be tested, ``row_counts`` how many rows each table
    was written with. Intermediate tables are deleted at the
    end; the frames returned read the written results.
    """
    scratch = Scratch(spark)
    out = run(read_inputs(spark, config), config, scratch.keep)
    base = config.output.rstrip("/")
    writes = CountedWrites(spark)
    writes.write(
        "overlap_table",
        out.overlap.drop("left_sid", "right_sid"),
        lambda df: writers.write_json_gz(df, f"{base}/overlap_table"),
    )
    writes.write("coloc_raw", out.coloc_raw, lambda df: writers.write_parquet_snappy(df, f"{base}/coloc_raw.parquet"))
    writers.write_csv_gz(out.coloc_raw, f"{base}/coloc_raw.csv")
    parquet = lambda name: lambda df: df.write.mode("overwrite").parquet(f"{base}/{name}.parquet")
    laid_out = writers.range_layout(out.coloc_processed, n=config.output_partitions)
    writes.write("coloc_processed", laid_out, parquet("coloc_processed"))
    written = {}
    for name in ("manifest", "reduced", "failures"):
        writes.write(name, getattr(out, name), parquet(name))
        written[name] = spark.read.parquet(f"{base}/{name}.parquet")
    parquet("row_counts")(writes.report().coalesce(1))
    scratch.clear()
    return Outputs(
        overlap=readers.scan_overlaps(spark, f"{base}/overlap_table"),
        coloc_raw=spark.read.parquet(f"{base}/coloc_raw.parquet"),
        coloc_processed=spark.read.parquet(f"{base}/coloc_processed.parquet"),
        **written,
    )
