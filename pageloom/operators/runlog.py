"""Step log of a run: records, statistics, time spans, severity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "step string, start string, finish string, duration string, operation string, digest string, kind string, error string"
# Steps a record may carry, and their log levels.
LEVELS = {"INIT": "info", "DONE": "info", "WARN": "warn", "FAIL": "error"}


def parse_log(lines: DataFrame, column: str = "value") -> DataFrame:
    """Typed records out of JSON lines; colour codes around a record are ignored."""
    plain = F.regexp_replace(F.col(column), "\x1b\\[[0-9;]*m", "")
    rec = lines.select(F.from_json(plain, SCHEMA).alias("r")).select("r.*")
    return rec.withColumns({c: F.expr(f"try_cast(trim({c}) as double)") for c in ("start", "finish", "duration")})


def step_log(outcomes: DataFrame) -> DataFrame:
    """JSON lines with an INIT record and an outcome record per step.

    Needs digest, operation, kind, step, start, duration.
    """
    number = "format_string('%6.2f', {})"
    both = outcomes.selectExpr(
        "*",
        f"""explode(array(
          named_struct('step', 'INIT', 'start', {number.format('start')}, 'finish', {number.format('start')}, 'duration', '      ', 'error', cast(null as string)),
          named_struct('step', step, 'start', {number.format('start')}, 'finish', {number.format('start + duration')}, 'duration', {number.format('duration')},
            'error', case when step in ('WARN', 'FAIL') then concat('Error in ', operation) end))) AS rec""",
    )
    return both.selectExpr(
        "to_json(named_struct('step', rec.step, 'start', rec.start, 'finish', rec.finish, 'duration', rec.duration, "
        "'operation', operation, 'digest', digest, 'kind', kind, 'error', rec.error)) AS value"
    )


def step_stats(log: DataFrame) -> DataFrame:
    """Per operation and kind: count, failure share, mean, median and 95th percentile.

    Durations have two decimals, so the exact percentile works on few distinct values.
    """
    return (
        log.where("step <> 'INIT'")
        .groupBy("operation", "kind")
        .agg(
            F.count(F.lit(1)).alias("n"),
            (F.count_if(F.col("step") == "FAIL") / F.count(F.lit(1))).alias("fail_rate"),
            F.avg("duration").alias("mean"),
            F.percentile("duration", 0.5).alias("p50"),
            F.percentile("duration", 0.95).alias("p95"),
        )
    )


def step_spans(log: DataFrame) -> DataFrame:
    """(digest, operation, start, finish, outcome): each INIT paired with the record after it."""
    w = "OVER (PARTITION BY digest, operation ORDER BY start, case when step = 'INIT' then 0 else 1 end)"
    nexts = log.selectExpr(
        "*", f"lead(named_struct('step', step, 'finish', finish)) {w} AS _next"
    ).where("step = 'INIT'")
    return nexts.selectExpr(
        "digest",
        "operation",
        "start",
        "case when _next.step <> 'INIT' then _next.finish end AS finish",
        "case when _next.step <> 'INIT' then _next.step else 'OPEN' end AS outcome",
    )


def apply_severity(log: DataFrame, suppressed: list[str]) -> DataFrame:
    """Add ``level`` and ``quarantined``; a failed step whose operation is not suppressed stops the job."""
    level = F.coalesce(*[F.when(F.col("step") == s, F.lit(v)) for s, v in LEVELS.items()])
    quiet = F.col("operation").isin(*suppressed) if suppressed else F.lit(False)
    failed = F.col("step") == "FAIL"
    stop = F.raise_error(F.concat(F.lit("step failed: "), F.coalesce("error", "operation"))).cast("boolean")
    return log.withColumns({"level": level, "quarantined": F.when(failed & ~quiet, stop).otherwise(failed)})
