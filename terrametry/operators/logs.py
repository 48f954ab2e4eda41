"""Log analytics: filters, histograms, top terms."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

# fixed values: levels the error panels select
ERROR_LEVELS = ("ERROR", "error", "WARN", "warn")
# fixed values: ingest-rate marks per one-minute bucket
RATE_MARKS = ((100, "green"), (1000, "yellow"))
NICE_STEPS = tuple(
    timedelta(seconds=s) for s in (
        1, 5, 10, 30, 60, 300, 600, 1800, 3600, 10_800, 21_600, 43_200, 86_400, 604_800,
    )
)


def interval(step: timedelta) -> str:
    return f"{int(step.total_seconds())} seconds"


def is_blank(message: str | Column = "message") -> Column:
    text = F.col(message) if isinstance(message, str) else message
    return text.rlike(r"^\s*$")


def drop_blank(df: DataFrame, message: str = "message") -> DataFrame:
    """Leave out lines of white space; events without the field stay."""
    return df.filter(~F.coalesce(is_blank(message), F.lit(False)))


def has_field(c: str) -> Column:
    return F.col(c).isNotNull()


def since(df: DataFrame, ts: str, as_of, span: timedelta) -> DataFrame:
    """Rows of the last ``span`` up to ``as_of``."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    low = now - F.expr(f"INTERVAL '{int(span.total_seconds())}' SECOND")
    return df.filter((F.col(ts) >= low) & (F.col(ts) <= now))


def auto_step(df: DataFrame, ts: str, buckets: int = 60) -> timedelta:
    """Smallest round step that covers the time range in at most ``buckets``;
    beyond the listed steps, a whole number of weeks.

    Scans the time column alone and reads one row, the bounds, to the driver.
    """
    low, high = df.agg(F.min(ts), F.max(ts)).first()
    span = (high - low) if low is not None else timedelta(0)
    weeks = -(-span // (NICE_STEPS[-1] * buckets))
    return next((step for step in NICE_STEPS if step * buckets >= span), NICE_STEPS[-1] * weeks)


def _zero_filled(counts: DataFrame, step: timedelta, by: Sequence[str]) -> DataFrame:
    """Add the empty buckets between first and last bucket, per ``by`` group.

    The bucket list is generated in two levels (days, then steps in the day),
    from the folded counts; the days are dealt to all tasks in between.
    """
    width = F.expr(f"INTERVAL '{int(step.total_seconds())}' SECOND")
    coarse_s = max(86_400, int(step.total_seconds()))
    coarse_s -= coarse_s % int(step.total_seconds())
    coarse = F.expr(f"INTERVAL '{coarse_s}' SECOND")
    measures = [c for c in counts.columns if c not in (*by, "bucket")]
    # always true, but reads every measure: the bounds then come from the same
    # shuffle as the counts, instead of a second scan with fewer columns
    seen = F.when(F.hash(*measures) <= 2**31 - 1, F.col("bucket"))
    bounds = counts.groupBy(*by).agg(F.min(seen).alias("_low"), F.max(seen).alias("_high"))
    spine = (
        bounds.filter(F.col("_low").isNotNull())
        .withColumn("_day", F.explode(F.sequence("_low", "_high", coarse)))
        .repartition("_day", *by)
        .withColumn("_end", F.least(F.col("_high"), F.col("_day") + coarse - width))
        .select(*by, F.explode(F.sequence("_day", "_end", width)).alias("bucket"))
    )
    zeros = spine.select("bucket", *by, *[F.lit(0).alias(m) for m in measures])
    return counts.unionByName(zeros).groupBy("bucket", *by).agg(
        *[F.sum(m).alias(m) for m in measures]
    )


def date_histogram(
    df: DataFrame, ts: str, step: timedelta, by: Sequence[str] = (),
    zero_fill: bool = True, measures: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Tumbling buckets ``(bucket, *by, n, …)``, empty ones counted as zero.

    ``measures`` adds further counts. Rows without a time are in no bucket.
    """
    extra = [column.alias(name) for name, column in (measures or {}).items()]
    counts = (
        df.groupBy(F.window(ts, interval(step)).alias("_w"), *by)
        .agg(F.count(F.lit(1)).alias("n"), *extra)
        .select(F.col("_w.start").alias("bucket"), *by, "n", *(measures or {}))
    )
    return _zero_filled(counts, step, by) if zero_fill else counts


def total_vs_errors(
    df: DataFrame, ts: str, step: timedelta, level: str = "level",
    errors: Sequence[str] = ERROR_LEVELS, zero_fill: bool = True,
) -> DataFrame:
    """All events and error events per bucket, from one scan."""
    return date_histogram(
        df, ts, step, zero_fill=zero_fill,
        measures={"n_errors": F.count_if(F.col(level).isin(*errors))},
    )


def top_term_histogram(
    df: DataFrame, ts: str, step: timedelta, term: str = "level", k: int = 6,
    zero_fill: bool = True,
) -> DataFrame:
    """Histogram of the ``k`` commonest terms; each runs from its own first to
    last bucket. Terms are ranked on the folded counts, not by a second scan."""
    counts = date_histogram(df.filter(has_field(term)), ts, step, [term], zero_fill=False)
    top = (
        counts.groupBy(term).agg(F.sum("n").alias("_total"))
        .orderBy(F.desc("_total"), term).limit(k).select(term)
    )
    # top has at most k rows; an inner join, since a semi join would be pushed
    # below the counts and make them differ from those that ranked the terms
    kept = counts.join(F.broadcast(top), term)
    return _zero_filled(kept, step, [term]) if zero_fill else kept.select("bucket", term, "n")


def top_terms(df: DataFrame, term: str, k: int = 10) -> DataFrame:
    """``k`` commonest values with count and percent share of those shown."""
    counts = (
        df.filter(has_field(term)).groupBy(term).agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), term).limit(k)
    )
    shown = F.sum("n").over(Window.partitionBy())  # over the k rows of the limit
    return counts.select(term, "n", (F.col("n") * 100 / shown).alias("share_pct"))


def document_total(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n"))


def cardinality(df: DataFrame, term: str, exact: bool = False) -> DataFrame:
    """Distinct values: a bounded sketch by default, or the exact count."""
    counter = F.count_distinct if exact else F.approx_count_distinct
    return df.agg(counter(term).alias("n_distinct"))


def recent(
    df: DataFrame, ts: str, k: int = 500, levels: Sequence[str] | None = None,
    level: str = "level", tiebreak: Sequence[str] = (),
) -> DataFrame:
    """Newest ``k`` events, optionally of some levels only."""
    kept = df.filter(F.col(level).isin(*levels)) if levels else df
    return kept.orderBy(F.desc(ts), *[F.desc(c) for c in tiebreak]).limit(k)


def reduce_series(
    histogram: DataFrame, value: str = "n", by: Sequence[str] = (), order: str = "bucket"
) -> DataFrame:
    """Legend figures of each series: sum, max, mean, last value present."""
    present = F.col(value).isNotNull()
    return histogram.groupBy(*by).agg(
        F.sum(value).alias("sum"),
        F.max(value).alias("max"),
        F.try_divide(F.sum(value), F.count(value)).alias("mean"),
        F.max_by(value, F.when(present, F.col(order))).alias("last"),
    )


def last_bucket(
    df: DataFrame, ts: str, step: timedelta = timedelta(minutes=1),
    marks: Sequence[tuple[float, str]] = RATE_MARKS, above: str = "red",
) -> DataFrame:
    """Count in the newest bucket and the mark it reaches."""
    counts = date_histogram(df, ts, step, zero_fill=False)
    chain = F
    for upper, label in marks:
        chain = chain.when(F.col("n") < upper, label)
    newest = counts.agg(F.max("bucket").alias("bucket"), F.max_by("n", "bucket").alias("n"))
    return newest.withColumn("mark", chain.otherwise(above))
