"""Labelled time series: counters, gauges, vector matching.

Samples are rows of label columns (no NULLs: an absent label is the empty one), a
time and a value, with at most one sample per series and time. Anything that needs the previous sample works in time
slices, so a series holding much of the data is spread over many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from .latest import latest_per_key

LOOKBACK = timedelta(minutes=5)
# Seconds of a series that one task holds, unless a window is shorter.
SLICE_S = 21_600
# Fixed value: slices over which samples without time are spread.
TIMELESS_SLICES = 1024


def seconds(n: float) -> Column:
    return F.expr(f"INTERVAL '{n:.6f}' SECOND")


def promote_labels(samples: DataFrame, labels: Sequence[str], column: str = "labels") -> DataFrame:
    """Labels of the map as columns of their own; an absent label is empty."""
    return samples.withColumns(
        {name: F.coalesce(F.col(column)[name], F.lit("")) for name in labels}
    ).drop(column)


def relabel(df: DataFrame, names: Mapping[str, str], drop: Sequence[str] = ()) -> DataFrame:
    return df.drop(*drop).withColumnsRenamed(dict(names))


def time_slices(
    df: DataFrame, ts: str, width_s: int, reach: Column | None = None
) -> DataFrame:
    """Rows with ``_slice`` (start of their slice) and ``_own``.

    A row in the last ``reach`` (an interval) of a slice also appears in the
    next one with ``_own`` false, so that each slice sees that much of its past.
    """
    start = F.window(ts, f"{width_s} seconds").start
    if reach is None:
        return df.withColumn("_slice", start).withColumn("_own", F.lit(True))
    following = F.col("_start") + seconds(width_s)
    late = F.col(ts) >= following - reach
    placed = F.when(late, F.array("_start", following)).otherwise(F.array("_start"))
    return (
        df.withColumn("_start", start)
        .withColumn("_slice", F.explode(placed))
        .withColumn("_own", F.col("_slice") == F.col("_start"))
        .drop("_start")
    )


def _growth(before: Column, value: Column) -> Column:
    """Growth from one value to the next; a fall is a restart from zero."""
    return F.when(value < before, value).otherwise(value - before)


def counter_increase(
    samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
    range_s: int = 3600, slice_s: int | None = None, reach: Column | None = None,
) -> DataFrame:
    """Each sample with ``increase``: growth of the counter in the closed window
    of ``range_s`` seconds ending at it.

    A fall of the value is a restart from zero. Only samples inside the window
    count: there is no extrapolation to its edges, and a window with a single
    sample gives NULL. ``reach`` may give each series its own window, an interval
    of at most ``range_s`` seconds. Windows longer than ``SLICE_S`` (or than a given
    ``slice_s``) go by slice summaries: a task then holds one slice of a series,
    however long the window.
    """
    reach = seconds(range_s) if reach is None else reach
    if range_s > (slice_s or SLICE_S):
        return _long_increase(samples, series, ts, value, reach, range_s, slice_s or SLICE_S)
    return _short_increase(samples, series, ts, value, reach, max(slice_s or 4 * range_s, range_s))


def _short_increase(samples: DataFrame, series: Sequence[str], ts: str, value: str, reach: Column, width: int) -> DataFrame:
    """Slices that see the windows of their first samples."""
    within = Window.partitionBy(*series, "_slice").orderBy(ts)
    before = F.lag(value).over(within)
    step = F.when(before.isNull(), F.col(value) - F.col(value)).otherwise(_growth(before, F.col(value)))
    running = (
        time_slices(samples, ts, width, reach)
        .withColumn("_step", step)
        .withColumn("_run", F.sum("_step").over(within.rowsBetween(Window.unboundedPreceding, 0)))
    )
    # each sample also looks from the start of its window for the sample next to
    # it: one more sort in the slice, however many samples a window holds
    sample = F.struct(F.col(ts).alias("at"), F.lit(0).alias("probe"))
    probe = F.struct((F.col(ts) - reach).alias("at"), F.lit(1).alias("probe"))
    backwards = (
        Window.partitionBy(*series, "_slice").orderBy(F.desc("_p.at"), "_p.probe")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    is_sample = F.col("_p.probe") == 0
    based = (
        running.withColumn("_p", F.explode(
            F.when(F.col("_own"), F.array(sample, probe)).otherwise(F.array(sample))))
        .withColumn("_base", F.last(F.when(is_sample, F.col("_run")), True).over(backwards))
        .withColumn("_first", F.last(F.when(is_sample, F.col(ts)), True).over(backwards))
        .filter(~is_sample)
    )
    increase = F.when(F.col("_first") < F.col(ts), F.col("_run") - F.col("_base"))
    return based.withColumn("increase", increase.cast("double")).drop(
        "_slice", "_own", "_step", "_run", "_p", "_base", "_first"
    )


def counter_summaries(samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
                      slice_s: int = SLICE_S) -> DataFrame:
    """One row per series and slice, ``(*series, _slice, first_ts, first, last, growth)``.

    Neighbouring slices merge: their growths add up with the growth from the
    one's last to the other's first value.
    """
    stepped = _stepped(samples, series, ts, value, slice_s)
    return _summed(stepped, [*series], ts, value)


def _stepped(samples: DataFrame, series: Sequence[str], ts: str, value: str, slice_s: int) -> DataFrame:
    """Samples with ``_slice`` and ``_run``, the growth since the slice's first sample."""
    within = Window.partitionBy(*series, "_slice").orderBy(ts)
    before = F.lag(value).over(within)
    step = F.when(before.isNull(), F.col(value) - F.col(value)).otherwise(_growth(before, F.col(value)))
    return time_slices(samples, ts, slice_s).drop("_own").withColumn("_step", step).withColumn(
        "_run", F.sum("_step").over(within.rowsBetween(Window.unboundedPreceding, 0))).drop("_step")


def _summed(stepped: DataFrame, series: Sequence[str], ts: str, value: str) -> DataFrame:
    return stepped.groupBy(*series, "_slice").agg(
        F.min(ts).alias("first_ts"), F.min_by(value, ts).alias("first"), F.max_by(value, ts).alias("last"),
        F.max_by("_run", ts).alias("growth"))


def _long_increase(
    samples: DataFrame, series: Sequence[str], ts: str, value: str, reach: Column, range_s: int, slice_s: int,
) -> DataFrame:
    """The counter's growth since the series began, as prefix sums over slices; a window's
    increase is the difference between its ends.

    A sample looks from the start of its window for the sample next to it, in the slice
    that holds this time. A slice ends with a mark of the next slice's first sample; slices
    without samples have that mark alone, as far back as a window reaches.
    """
    rest = [c for c in samples.columns if c not in series]
    keyed = samples.select(F.struct(*series).alias("_series"), *rest)  # equal also where labels are NULL
    stepped = _stepped(keyed, ["_series"], ts, value, slice_s)
    by_slice = Window.partitionBy("_series").orderBy("_slice")
    none = F.col("first") - F.col("first")
    joint = F.coalesce(_growth(F.lag("last").over(by_slice), F.col("first")) + F.lag("growth").over(by_slice), none)
    entries = _summed(stepped, ["_series"], ts, value).withColumns(
        {"_joint": joint, "_previous": F.lag("_slice").over(by_slice)}).select(
        "_series", "_slice", "_previous", F.col("first_ts").alias("_first"),
        F.sum("_joint").over(by_slice.rowsBetween(Window.unboundedPreceding, 0)).alias("_total"))
    own = stepped.join(entries.select("_series", "_slice", F.col("_total").alias("_entry")), ["_series", "_slice"])
    own = own.select("*", "_series.*")  # the window may depend on the labels
    grown = own.withColumn("_total", F.col("_entry") + F.col("_run")).withColumn("_from", F.col(ts) - reach)
    grown = grown.withColumn("_home", F.window("_from", f"{slice_s} seconds").start)
    payload = F.struct(*rest)
    mark = F.struct("_slice", F.col(ts).alias("_at"), F.lit(0).alias("_probe"), F.col(ts).alias("_first"), F.lit(None).cast(grown.select(payload.alias("p")).schema["p"].dataType).alias("_row"))
    probe = F.struct(F.col("_home").alias("_slice"), F.col("_from").alias("_at"), F.lit(1).alias("_probe"),
                     F.lit(None).cast(samples.schema[ts].dataType).alias("_first"), payload.alias("_row"))
    looked = grown.select("_series", "_total", F.explode(F.array(mark, probe)).alias("m")).select("_series", "_total", "m.*")
    back = F.col("_slice") - seconds((range_s // slice_s + 1) * slice_s)
    earlier = F.sequence(F.greatest(back, F.coalesce("_previous", back)), F.col("_slice") - seconds(slice_s), seconds(slice_s))
    ends = entries.withColumn("_slice", F.explode(earlier)).select(
        "_series", "_total", "_slice", (F.col("_slice") + seconds(slice_s)).alias("_at"), F.lit(0).alias("_probe"), "_first",
        F.lit(None).cast(looked.schema["_row"].dataType).alias("_row"))
    next_to = Window.partitionBy("_series", "_slice").orderBy(F.desc("_at"), "_probe").rowsBetween(Window.unboundedPreceding, 0)
    is_mark = F.col("_probe") == 0
    based = looked.unionByName(ends).withColumns({
        "_first": F.last("_first", True).over(next_to),
        "_base": F.last(F.when(is_mark, F.col("_total")), True).over(next_to)}).filter(~is_mark)
    increase = F.when(F.col("_first") < F.col(f"_row.`{ts}`"), F.col("_total") - F.col("_base")).cast("double")
    whole = based.select("_series.*", "_row.*", increase.alias("increase"))
    return whole.select(*samples.columns, "increase")


def counter_rate(
    samples: DataFrame, series: Sequence[str], ts: str = "ts", value: str = "value",
    range_s: int = 300, slice_s: int | None = None,
) -> DataFrame:
    """As :func:`counter_increase`, per second of the window, as ``rate``."""
    grown = counter_increase(samples, series, ts, value, range_s, slice_s)
    return grown.withColumn("rate", F.col("increase") / range_s).drop("increase")


def instant(
    samples: DataFrame, series: Sequence[str], as_of: datetime | Column | None = None,
    ts: str = "ts", value: str = "value", lookback: timedelta | None = LOOKBACK,
) -> DataFrame:
    """Latest sample of each series at ``as_of``, none older than ``lookback``."""
    if as_of is not None:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
        samples = samples.filter(F.col(ts) <= now)
        if lookback is not None:
            samples = samples.filter(F.col(ts) > now - seconds(lookback.total_seconds()))
    return samples.groupBy(*series).agg(
        F.max(ts).alias(ts), F.max_by(value, ts).alias(value)
    )


def _micros(at: Column, kind: T.DataType) -> Column:
    """Microseconds since 1970, of a time with or without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") if isinstance(kind, T.TimestampNTZType) else F.timestamp_seconds(F.lit(0))
    return F.timestamp_diff("MICROSECOND", epoch, at)


def step_before(at: Column, step: timedelta, kind: T.DataType) -> Column:
    """The last evaluation time, a multiple of ``step``, at or before ``at``."""
    over = F.pmod(_micros(at, kind), F.lit(round(step.total_seconds() * 1_000_000)))
    return at - F.make_dt_interval(secs=(over / 1_000_000).cast("decimal(18,6)"))


def step_after(at: Column, step: timedelta, kind: T.DataType) -> Column:
    """The first evaluation time at or after ``at``."""
    return step_before(at + seconds(step.total_seconds() - 0.000001), step, kind)


def covered(
    samples: DataFrame, series: Sequence[str], step: timedelta, lookback: timedelta = LOOKBACK,
    ts: str = "ts", value: str = "value", slice_s: int = 21_600,
) -> DataFrame:
    """Stretches of evaluation times that see one sample: ``(*series, _slice, _from, _before, value)``.

    Evaluation times are the multiples of ``step``. A sample counts from the first
    one at or after it until the series' next sample, and for less than ``lookback``;
    ``_before`` is the first that no longer sees it. A stretch is one row however
    many evaluation times it holds, and is cut where a time slice ends; slices see
    the last ``lookback`` before them.
    """
    every = int(step.total_seconds())
    width = -(-max(slice_s, int(lookback.total_seconds())) // every) * every
    kind = samples.schema[ts].dataType
    reach = seconds(lookback.total_seconds())
    placed = samples.select(*series, ts, value, step_after(F.col(ts), step, kind).alias("_at"))
    # of several samples before one evaluation the last counts: the others' stretches are empty
    following = F.lead("_at").over(Window.partitionBy(*series, "_slice").orderBy(ts))
    gone = step_after(F.col(ts) + reach, step, kind)
    return time_slices(placed, "_at", width, reach).withColumns({
        "_from": F.greatest("_at", "_slice"),
        "_before": F.least(gone, F.col("_slice") + seconds(width), F.coalesce(following, gone)),
    }).filter(F.col("_from") < F.col("_before")).select(*series, "_slice", "_from", "_before", value)


def gauge_series(
    samples: DataFrame, series: Sequence[str], step: timedelta, ts: str = "ts",
    value: str = "value",
) -> DataFrame:
    """Last value of each series in each step."""
    return (
        samples.groupBy(*series, F.window(ts, f"{int(step.total_seconds())} seconds").alias("_w"))
        .agg(F.max_by(value, ts).alias(value))
        .select(*series, F.col("_w.start").alias("step"), value)
    )


def series_count(samples: DataFrame, series: Sequence[str], **at) -> DataFrame:
    """Number of series alive."""
    return instant(samples, series, **at).agg(F.count(F.lit(1)).alias("n_series"))


def age_seconds(as_of: Column | str, ts: Column | str) -> Column:
    """Seconds from ``ts`` to ``as_of`` for times given as epoch seconds."""
    as_of = F.col(as_of) if isinstance(as_of, str) else as_of
    return as_of - (F.col(ts) if isinstance(ts, str) else ts)


def vector_div(
    left: DataFrame, right: DataFrame, labels: Sequence[str], value: str = "value"
) -> DataFrame:
    """Quotient of the samples whose labels are equal; a zero divisor gives NULL."""
    divisor = right.select(*labels, F.col(value).alias("_divisor"))
    return left.join(divisor, list(labels), "inner").select(
        *labels, F.try_divide(F.col(value), F.col("_divisor")).alias(value)
    )


def vector_and(left: DataFrame, right: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Left samples whose labels occur on the right."""
    return left.join(right.select(*labels), list(labels), "left_semi")


def vector_or(left: DataFrame, right: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Left samples, and those right samples whose labels are not on the left.

    Labels are unique on each side, so both sides fold by label in one shuffle
    and neither is computed twice.
    """
    sides = left.withColumn("_left", F.lit(1)).unionByName(right.withColumn("_left", F.lit(0)))
    rest = [c for c in left.columns if c not in labels]
    return sides.groupBy(*labels).agg(
        *[F.max_by(c, "_left").alias(c) for c in rest]
    ).select(*left.columns)


def absent(
    expected: DataFrame, samples: DataFrame, labels: Sequence[str],
    as_of: datetime | Column | None = None, ts: str = "ts",
    max_age: timedelta | None = LOOKBACK,
) -> DataFrame:
    """Expected series without a sample in the last ``max_age``."""
    if as_of is not None:
        now = as_of if isinstance(as_of, Column) else F.lit(as_of)
        samples = samples.filter(F.col(ts) <= now)
        if max_age is not None:
            samples = samples.filter(F.col(ts) >= now - seconds(max_age.total_seconds()))
    return expected.join(samples.select(*labels).distinct(), list(labels), "left_anti")


def _runs(
    samples: DataFrame, series: Sequence[str], condition: Column, ts: str,
    staleness_s: float, slice_s: int, spread: Column | None = None, until: str | None = None,
) -> DataFrame:
    """Samples with ``_on`` and, per slice, the start ``_begin`` of their run.

    ``_begin`` is NULL while a run may have come from an earlier slice. Samples
    without time stay if ``spread`` gives them times that deal them over slices;
    they begin and end no run there. A row may stand for a stretch from ``ts`` to
    ``until``.
    """
    in_slice = Window.partitionBy(*series, "_slice").orderBy(ts)
    previous = F.lag(until or ts).over(in_slice)
    broken = ~F.lag("_on").over(in_slice) | (F.col(ts) - previous > seconds(staleness_s))
    begins = F.when(F.col("_on") & previous.isNotNull() & broken, F.col(ts))
    times = F.col(ts) if spread is None else F.coalesce(F.col(ts), spread)
    sliced = time_slices(
        samples.withColumn("_on", F.coalesce(condition, F.lit(False))).withColumn("_at", times), "_at", slice_s
    ).drop("_own", "_at").filter(F.col("_slice").isNotNull())
    return sliced.withColumn("_begin", begins).withColumn(
        "_begin",
        F.last("_begin", ignorenulls=True).over(in_slice.rowsBetween(Window.unboundedPreceding, 0)),
    )


def _linked_slices(
    runs: DataFrame, series: Sequence[str], ts: str, staleness_s: float,
    keep: Sequence[str] = (), until: str | None = None, earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per series and slice: where the run entering it (``_entry``) and
    the run leaving it (``_exit``) began. ``keep`` columns are those of the
    last sample. ``earlier`` holds a series' summary of all older samples: it
    merges like a slice before all others."""
    edges = runs.groupBy(*series, "_slice").agg(
        F.min(ts).alias("_in"), F.min_by("_on", ts).alias("_in_on"),
        F.max(until or ts).alias("_out"), F.max_by("_on", ts).alias("_out_on"),
        F.max("_begin").alias("_out_begin"),
        *[F.max_by(c, ts).alias(c) for c in keep],
    ).filter(F.col("_in").isNotNull())
    if earlier is not None:
        # no slice of newer samples begins before that of the summary's last instant
        edges = edges.unionByName(earlier.select(
            *series, F.col("_slice"), F.col("_out").alias("_in"), F.col("_out_on").alias("_in_on"), "_out", "_out_on",
            F.when(F.col("_out_on"), F.col("_exit")).alias("_out_begin"), *keep))
    by_slice = Window.partitionBy(*series).orderBy("_slice")
    linked = F.coalesce(
        F.col("_in_on") & F.lag("_out_on").over(by_slice)
        & (F.col("_in") - F.lag("_out").over(by_slice) <= seconds(staleness_s)),
        F.lit(False),
    )
    # a slice either settles where its last run began, or passes the run through
    settled = F.coalesce(F.col("_out_begin"), F.when(~F.col("_linked"), F.col("_in")))
    return (
        edges.withColumn("_linked", linked)
        .withColumn("_exit", F.last(settled, ignorenulls=True).over(
            by_slice.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("_entry", F.when(F.col("_linked"), F.lag("_exit").over(by_slice))
                    .otherwise(F.col("_in")))
    )


def _state(on: Column, ts: str, hold: Column | float) -> Column:
    hold = hold if isinstance(hold, Column) else F.lit(float(hold))
    held = F.make_dt_interval(secs=hold.cast("decimal(18,6)"))
    return F.when(~on, "inactive").when(
        F.col(ts) - F.col("active_since") >= held, "firing"
    ).otherwise("pending")


def alert_hold(
    samples: DataFrame, series: Sequence[str], condition: Column, hold: Column | float,
    ts: str = "ts", staleness_s: float = 300, slice_s: int = 21_600,
) -> DataFrame:
    """Each sample with ``active_since`` and ``state``.

    A series is ``pending`` while its condition stays true and ``firing`` once
    it has been true for ``hold`` seconds. A false or NULL condition ends the
    run, and so does a gap between samples longer than ``staleness_s``. A NULL
    label is a label like any other: the samples that lack it are one series.
    A sample without time stays, outside every run: ``active_since`` is NULL and
    it is ``pending`` or ``inactive`` by its own condition.

    Runs are found inside each time slice, then linked across slices through
    one summary row per series and slice. Summaries and samples come from one
    scan and one shuffle.
    """
    # a struct is never NULL and equals one with the same NULLs, in windows and in the join
    keyed = samples.withColumn("_series", F.struct(*series))
    plain = lambda df: [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.timestamp_seconds(F.pmod(F.xxhash64(*plain(samples)), F.lit(TIMELESS_SLICES)) * slice_s)
    runs = _runs(keyed, ["_series"], condition, ts, staleness_s, slice_s, spread)
    # always the time, but reads every column, so that both uses of the runs share their shuffle
    hashed = plain(runs)
    whole = runs.withColumn(ts, F.when(F.hash(*hashed) <= 2**31 - 1, F.col(ts)))
    entries = _linked_slices(whole, ["_series"], ts, staleness_s).select("_series", "_slice", "_entry")
    joined = runs.join(entries, ["_series", "_slice"], "left")  # no summary where no sample has a time
    since = F.when(F.col("_on") & F.col(ts).isNotNull(), F.coalesce("_begin", "_entry"))
    return (
        joined.withColumn("active_since", since)
        .withColumn("state", _state(F.col("_on"), ts, hold))
        .drop("_series", "_slice", "_on", "_begin", "_entry")
    )


def run_summaries(
    samples: DataFrame, series: Sequence[str], condition: Column, ts: str = "ts",
    value: str = "value", staleness_s: float = 300, slice_s: int = 21_600,
    until: str | None = None, earlier: DataFrame | None = None,
) -> DataFrame:
    """One row per series: its last instant ``_out`` and value, whether the condition
    held there (``_out_on``) and since when (``_exit``).

    Summaries merge: given those of all older samples as ``earlier``, the result is
    that of all samples, and only the newer ones are read.
    """
    runs = _runs(samples, series, condition, ts, staleness_s, slice_s, until=until)
    if earlier is not None:
        own = F.window("_out", f"{slice_s} seconds").start - seconds(1)
        earlier = earlier.withColumn("_slice", own)
    linked = _linked_slices(runs, series, ts, staleness_s, [value], until, earlier)
    return latest_per_key(linked, series, ["_slice"]).select(*series, "_out", "_out_on", "_exit", value)


def states_of(
    summaries: DataFrame, series: Sequence[str], hold: Column | float, as_of: datetime | Column,
    ts: str = "ts", value: str = "value", staleness_s: float = 300,
) -> DataFrame:
    """State at ``as_of`` of each series that :func:`run_summaries` gives; one gone quiet is inactive."""
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    live = F.col("_out") >= now - seconds(staleness_s)
    return (
        summaries.withColumn("active_since", F.when(live & F.col("_out_on"), F.col("_exit")))
        .withColumn("state", _state(live & F.col("_out_on"), "_out", hold))
        .select(*series, F.col("_out").alias(ts), value, "active_since", "state")
    )


def alert_state(
    samples: DataFrame, series: Sequence[str], condition: Column, hold: Column | float,
    as_of: datetime | Column, ts: str = "ts", value: str = "value",
    staleness_s: float = 300, slice_s: int = 21_600,
) -> DataFrame:
    """State of each series at ``as_of``; a series gone quiet is inactive.

    As the last row of :func:`alert_hold`, but from the slice summaries alone:
    samples are read once and never joined back.
    """
    now = as_of if isinstance(as_of, Column) else F.lit(as_of)
    runs = run_summaries(samples.filter(F.col(ts) <= now), series, condition, ts, value, staleness_s, slice_s)
    return states_of(runs, series, hold, now, ts, value, staleness_s)
