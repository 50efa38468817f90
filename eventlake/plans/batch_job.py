"""The batch percentile job: scan -> clean -> outliers -> threshold ->
percentiles -> write result -> validation report, with stage row counts
gathered by ``Observation`` inside the passes that run anyway (no extra
``count()`` scans)."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from eventlake.operators.joins import null_safe_join, observed
from eventlake.operators.outliers import daily_bounds, flag_outliers
from eventlake.operators.percentiles import distinct_events, percentiles, with_run_metadata
from eventlake.operators.quality import prepare
from eventlake.operators.reports import validation_report
from eventlake.schema import DEFAULT_GROUP, MIN_EVENTS, OUTLIER_SIGMA
from eventlake.sources.files import read_result, scan_events
from eventlake.sources.writers import write_result

STAGES = (
    "input_rows",
    "cleaned_rows",
    "outliers",
    "rows_after_outliers",
    "type_days",
    "type_days_kept",
    "result_rows",
    "events_in_result",
)


@dataclass
class BatchConfig:
    input_path: str
    output_path: str
    day: str | None = None
    fmt: str = "parquet"
    min_events: int = MIN_EVENTS
    sigma: float = OUTLIER_SIGMA
    as_of: str | None = None
    count_before_outliers: bool = False
    method: str = "exact"  # exact | kll | approx


@dataclass
class BatchRun:
    result_path: str
    report_path: str
    counts: dict[str, int] = field(default_factory=dict)


def percentile_plan(events: DataFrame, cfg: BatchConfig, by=DEFAULT_GROUP) -> tuple[DataFrame, dict[str, Observation]]:
    """The observed plan (the same as ``percentile_report``). Observations
    sit on nodes that run on one path: the scan and the statistics are
    consumed first by the job that writes the statistics table, the per-group summary
    once by the result."""
    run = uuid.uuid4().hex
    obs = {k: Observation(f"{k}_{run}") for k in ("input", "stats", "summary")}
    events = events.observe(obs["input"], F.count(F.lit(1)).alias("input_rows"))
    cleaned = prepare(events)
    stats = daily_bounds(cleaned, by, cfg.sigma).observe(
        obs["stats"], F.sum("daily_count").alias("cleaned_rows"))
    clean = flag_outliers(cleaned, stats, by).filter(~F.col("is_outlier")).select(*cleaned.columns)
    if cfg.count_before_outliers:
        counts = distinct_events(cleaned, by)
        summary = null_safe_join(percentiles(clean, by, method=cfg.method), counts, by)
    else:
        summary = percentiles(clean, by, with_distinct_events=True, method=cfg.method)
    summary = summary.observe(
        obs["summary"], F.sum("total_events").alias("rows_after_outliers"),
        F.count(F.lit(1)).alias("type_days"),
        F.count_if(F.col("distinct_events") >= cfg.min_events).alias("type_days_kept"))
    result = summary.filter(F.col("distinct_events") >= cfg.min_events).drop("distinct_events")
    result = with_run_metadata(result, cfg.min_events, cfg.as_of)
    return result, obs


def run_batch(spark: SparkSession, cfg: BatchConfig) -> BatchRun:
    """Run the job: write the result and the validation report, return their
    paths and the observed stage counts."""
    events = scan_events(spark, cfg.input_path, day=cfg.day)
    result, obs = percentile_plan(events, cfg)
    out = cfg.output_path.rstrip("/")
    result_path = f"{out}/percentile_results.{cfg.fmt}"
    written_obs = Observation(f"result_{uuid.uuid4().hex}")
    result = result.observe(written_obs, F.count(F.lit(1)).alias("result_rows"),
                            F.sum("total_events").alias("events_in_result"))
    write_result(result, result_path, cfg.fmt, sort_by=DEFAULT_GROUP)
    # the report reads the written result back: tiny, and no recomputation
    written = read_result(spark, result_path, cfg.fmt, schema=result.schema)
    report_path = f"{out}/validation_report.csv"
    write_result(validation_report(written, cfg.as_of, cfg.min_events), report_path, "csv")
    counts = {}
    for o in [*obs.values(), written_obs]:
        counts.update({k: int(v or 0) for k, v in observed(o).items()})  # a stage of an empty plan reads 0
    counts["outliers"] = counts.get("cleaned_rows", 0) - counts.get("rows_after_outliers", 0)
    return BatchRun(result_path, report_path, {k: counts.get(k, 0) for k in STAGES})
