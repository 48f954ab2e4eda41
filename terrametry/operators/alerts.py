"""Alert rules as data, and their evaluation over samples."""

from __future__ import annotations

import operator
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions import matches_label
from ..session import stage
from .latest import latest_per_key
from .series import (
    LOOKBACK, SLICE_S, counter_increase, covered, run_summaries, seconds, states_of, step_after, step_before, time_slices,
)

COMPARE: dict[str, Callable] = {
    ">": operator.gt, "<": operator.lt, "==": operator.eq, "!=": operator.ne,
    ">=": operator.ge, "<=": operator.le,
}


@dataclass(frozen=True)
class Rule:
    """One alert rule.

    ``kind`` is ``gauge`` (value against threshold), ``count`` (number of series
    whose value passes ``member``, zero when all are gone), ``rate`` / ``increase`` (counter growth over
    ``range_s``), ``ratio`` (metric over ``divisor``, divisor above zero),
    ``age`` (evaluation time minus the value, an epoch second, against ``threshold``;
    or no matching series within the lookback) or ``absent`` (no sample, or none for
    ``threshold`` seconds).
    """

    name: str
    kind: str
    metric: str
    op: str = ">"
    threshold: float = 0.0
    hold_s: float = 60
    severity: str = "warning"
    label: str | None = None
    pattern: str = ".*"
    regex: bool = True
    range_s: int = 300
    divisor: str | None = None
    member: tuple[str, float] = ("==", 1.0)

    def selects(self) -> Column:
        if self.label is None:
            return F.lit(True)
        return matches_label(self.label, self.pattern, self.regex)


@dataclass(frozen=True)
class Progress:
    """What an evaluation leaves for the next: all older samples, in a form that merges.

    ``since`` is the time evaluated up to, ``runs`` the run summary of every rule and
    series, ``last`` the last sample of every series that absent and age rules watch,
    ``carry`` the tagged samples that later windows and lookbacks still reach.
    """

    since: Column
    runs: DataFrame
    last: DataFrame
    carry: DataFrame


@dataclass(frozen=True)
class _Setting:
    """How rules are evaluated, and the times between which."""

    labels: list[str]
    step: timedelta
    lookback: timedelta
    slice_s: int
    ts: str
    kind: T.DataType
    as_of: Column
    since: Column | None

    @property
    def key(self) -> list[str]:
        return ["rule", *self.labels]

    def floor(self, at: Column) -> Column:
        return step_before(at, self.step, self.kind)

    def ceil(self, at: Column) -> Column:
        return step_after(at, self.step, self.kind)

    @property
    def stride(self) -> Column:
        return seconds(self.step.total_seconds())

    def covered(self, samples: DataFrame, series: Sequence[str]) -> DataFrame:
        """Stretches of evaluation times that see one sample, of the times to evaluate."""
        found = covered(samples, series, self.step, self.lookback, self.ts, slice_s=self.slice_s)
        start = F.col("_from") if self.since is None else F.greatest(F.col("_from"), self.floor(self.since) + self.stride)
        end = F.least(F.col("_before"), self.floor(self.as_of) + self.stride)
        return found.withColumns({"_from": start, "_before": end}).filter(F.col("_from") < F.col("_before"))


def _per_rule(rules: Sequence[Rule], pick: Callable[[Rule], object]) -> Column:
    chain = F
    for rule in rules:
        chain = chain.when(F.col("rule") == rule.name, pick(rule))
    return chain


def _compared(rules: Sequence[Rule], value: Column | str = "value") -> Column:
    value = F.col(value) if isinstance(value, str) else value
    return _per_rule(rules, lambda r: COMPARE[r.op](value, F.lit(float(r.threshold))))


def tag(samples: DataFrame, rules: Sequence[Rule], labels: Sequence[str], metric: str = "metric", ts: str = "ts") -> DataFrame:
    """Samples once for each rule they belong to: ``(rule, kind, upper, *labels, ts, value)``.

    The tags of a sample are a short list for its metric, so no rule table is
    joined and other metrics are not read. ``upper`` is false for a ratio's divisor.
    """
    by_metric: dict[str, list[Column]] = {}
    for rule in rules:
        for name, upper in ((rule.metric, True), (rule.divisor, False)):
            if name is not None:
                one = F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.kind).alias("kind"), F.lit(upper).alias("upper"))
                by_metric.setdefault(name, []).append(F.when(rule.selects(), one))
    lists = F
    for name, tags in by_metric.items():
        lists = lists.when(F.col(metric) == name, F.array(*tags))
    return (
        samples.filter(F.col(metric).isin(*sorted(by_metric)))
        .withColumn("_tag", F.explode(lists)).filter(F.col("_tag").isNotNull())
        .select("_tag.rule", "_tag.kind", "_tag.upper", *labels, ts, "value")
    )


def _gauge(tagged, rules, how: _Setting, earlier):
    return tagged.select(
        *how.key, how.ts, F.col(how.ts).alias("until"), F.col("value").cast("double").alias("value"),
        _compared(rules).alias("condition"))


def _counter(tagged, rules, how: _Setting, earlier):
    """All counter rules in one pass, each with its own window."""
    grown = counter_increase(
        tagged.select(*how.key, how.ts, "value"), how.key, how.ts, "value", max(rule.range_s for rule in rules),
        reach=_per_rule(rules, lambda r: seconds(r.range_s)),
    )
    per = _per_rule(rules, lambda r: F.lit(float(r.range_s if r.kind == "rate" else 1)))
    return _gauge(grown.withColumn("value", F.col("increase") / per), rules, how, earlier)


def _ratio(tagged, rules, how: _Setting, earlier):
    """Sweep over the stretches of both sides: from one change to the next, both values stay."""
    sides = how.covered(tagged, [*how.key, "upper"])
    closes = F.struct(F.col("_before").alias("at"), F.lit(False).alias("open"), F.lit(None).cast("double").alias("value"))
    opens = F.struct(F.col("_from").alias("at"), F.lit(True).alias("open"), F.col("value").cast("double").alias("value"))
    changes = sides.withColumn("e", F.explode(F.array(opens, closes))).select(*how.key, "_slice", "upper", "e.*")
    order = Window.partitionBy(*how.key, "_slice").orderBy("at", "open")
    side = lambda upper: F.last(F.when(F.col("upper") == upper, F.struct("value")), True).over(
        order.rowsBetween(Window.unboundedPreceding, 0))["value"]
    # of several changes at one time the last row knows all
    both = changes.select(*how.key, F.col("at").alias(how.ts), F.lead("at").over(order).alias("_next"),
                          side(True).alias("_upper"), side(False).alias("_lower")).filter(
        (F.col(how.ts) < F.col("_next")) & F.col("_upper").isNotNull() & F.col("_lower").isNotNull())
    both = both.withColumns({"value": F.try_divide("_upper", "_lower"), "until": F.col("_next") - how.stride})
    return both.select(*how.key, how.ts, "until", "value", ((F.col("_lower") > 0) & _compared(rules)).alias("condition"))


def _count(tagged, rules, how: _Setting, earlier):
    """Sweep over presence: a stretch that passes adds one where it begins and takes one
    where it ends, and the running sum is the count from each change to the next.

    A rule counts from the first evaluation that saw any of its series; from then on
    it counts zero while all are gone. Sums go by slice, then over the slices.
    """
    passes = _per_rule(rules, lambda r: COMPARE[r.member[0]](F.col("value"), F.lit(r.member[1])))
    one = F.coalesce(passes, F.lit(False)).cast("long")
    ends = F.array(F.struct(F.col("_from").alias("at"), one.alias("n")), F.struct(F.col("_before").alias("at"), (-one).alias("n")))
    changes = how.covered(tagged, how.key).withColumn("e", F.explode(ends)).select("rule", "e.*")
    if earlier is not None:
        counted = earlier.filter(F.col("rule").isin(*[r.name for r in rules])).select("rule")
        changes = changes.unionByName(counted.select("rule", (how.floor(how.since) + how.stride).alias("at"), F.lit(0).cast("long").alias("n")))
    changes = time_slices(changes.groupBy("rule", "at").agg(F.sum("n").alias("n")), "at", how.slice_s).drop("_own")
    over = Window.partitionBy("rule").orderBy("_slice")
    slices = changes.groupBy("rule", "_slice").agg(F.sum("n").alias("_n"), F.min("at").alias("_at")).select(
        "rule", "_slice", (F.sum("_n").over(over.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")).alias("_before"),
        F.lead("_at").over(over).alias("_next"))
    inside = Window.partitionBy("rule", "_slice").orderBy("at")
    counted = changes.join(slices, ["rule", "_slice"]).select(
        "rule", F.col("at").alias(how.ts),
        (F.coalesce(F.lead("at").over(inside), F.col("_next"), how.floor(how.as_of) + how.stride) - how.stride).alias("until"),
        (F.col("_before") + F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))).cast("double").alias("value"))
    return counted.select(
        "rule", *[F.lit("").alias(name) for name in how.labels], how.ts, "until", "value", _compared(rules).alias("condition"))


def _age(tagged, rules, how: _Setting, earlier):
    """Age grows with the evaluation time alone, so a stretch is cut at most where it crosses the threshold."""
    limit = F.col("value").cast("double") + _per_rule(rules, lambda r: F.lit(float(r.threshold)))
    epoch = lambda at: F.unix_micros(at.cast("timestamp"))
    low, high = epoch(F.col("_from")) - 1, epoch(F.col("_before"))
    crossed = F.greatest(low.cast("double"), F.least(high.cast("double"), F.coalesce(limit * 1_000_000, low.cast("double"))))
    found = how.covered(tagged, how.key).withColumn("_cross", F.timestamp_micros(F.round(crossed).cast("long")).cast(how.kind))
    within = lambda at: F.greatest(F.col("_from"), F.least(F.col("_before"), at))
    bounds = [F.col("_from"), within(how.ceil(F.col("_cross"))), within(how.floor(F.col("_cross")) + how.stride), F.col("_before")]
    # a fixed list is exploded: of an exploded column the planner infers a filter, which repeats all that the column is made of
    edges = [f"_b{i}" for i in range(len(bounds))]
    pieces = found.withColumns(dict(zip(edges, bounds))).withColumn("_piece", F.explode(F.array(*[F.lit(i) for i in range(1, len(edges))])))
    cut = pieces.withColumn("p", F.struct(
        F.element_at(F.array(*edges[:-1]), F.col("_piece")).alias("a"), F.element_at(F.array(*edges[1:]), F.col("_piece")).alias("b"))).filter("p.a < p.b")
    age = lambda at: epoch(at) / 1_000_000 - F.col("value").cast("double")
    until = F.col("p.b") - how.stride
    return cut.select(*how.key, F.col("p.a").alias(how.ts), until.alias("until"), age(until).alias("value"),
                      _compared(rules, age(F.col("p.a"))).alias("condition"))


def _union(parts: Sequence[DataFrame]) -> DataFrame:
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


EVALUATORS = {
    "gauge": _gauge, "rate": _counter, "increase": _counter, "ratio": _ratio, "count": _count, "age": _age,
}


def _silent(last, rules, labels, as_of, expected) -> DataFrame:
    """Absent or stale series. Silence is true from ``last sample + threshold``
    on, so the hold follows from the last sample alone."""
    last = last.filter(F.col("rule").isin(*[r.name for r in rules]))
    if expected is None:
        waiting = last.sparkSession.createDataFrame(
            [(r.name, *[r.pattern if n == r.label else "" for n in labels]) for r in rules],
            ", ".join(f"`{n}` string" for n in ("rule", *labels)),
        )
        seen = last.select("rule").distinct()  # at most one row per rule
        waiting = waiting.join(F.broadcast(seen), "rule", "left_anti")
    else:
        waiting = expected.select("rule", *labels)
    known = (
        last.unionByName(waiting.withColumn("_last", F.lit(None)))
        .groupBy("rule", *labels).agg(F.max("_last").alias("_last"))
    )
    limit = _per_rule(rules, lambda r: seconds(r.threshold))
    held = _per_rule(rules, lambda r: seconds(r.hold_s))
    due = F.col("_last") + limit
    silent = F.col("_last").isNull() | (due < as_of)
    return known.select(
        "rule", *labels, F.lit(None).cast("double").alias("value"),
        F.when(silent, due).alias("active_since"),
        F.when(~silent, "inactive")
        .when(F.col("_last").isNull() | (as_of - due >= held), "firing")
        .otherwise("pending").alias("state"),
    )


def _unseen(last, rules, labels, as_of, lookback) -> DataFrame:
    """Age rules that no series matches within the lookback, under the labels they name."""
    last = last.groupBy("rule").agg(F.max("_last").alias("_last"))
    named = last.sparkSession.createDataFrame(
        [(r.name, *[r.pattern.rstrip("$") if n == r.label else "" for n in labels]) for r in rules],
        ", ".join(f"`{n}` string" for n in ("rule", *labels)),
    )
    due = F.col("_last") + seconds(lookback.total_seconds())
    held = _per_rule(rules, lambda r: seconds(r.hold_s))
    return named.join(last, "rule", "left").filter(F.col("_last").isNull() | (due <= as_of)).select(
        "rule", *labels, F.lit(None).cast("double").alias("value"), due.alias("active_since"),
        F.when(F.col("_last").isNull() | (as_of - due >= held), "firing").otherwise("pending").alias("state"),
    )


def _last_seen(tagged: DataFrame, key: Sequence[str], ts: str, earlier: DataFrame | None) -> DataFrame:
    last = tagged.filter(F.col("kind").isin("absent", "age")).groupBy(*key).agg(F.max(ts).alias("_last"))
    if earlier is None:
        return last
    return last.unionByName(earlier).groupBy(*key).agg(F.max("_last").alias("_last"))


def advance(
    tagged: DataFrame, rules: Sequence[Rule], as_of: Column, labels: Sequence[str],
    step: timedelta = timedelta(seconds=15), ts: str = "ts", staleness_s: float = 300,
    slice_s: int = SLICE_S, lookback: timedelta = LOOKBACK, before: Progress | None = None,
) -> Progress:
    """Evaluate the rules over :func:`tag`-ged samples, up to ``as_of``.

    With ``before``, ``tagged`` are its ``carry`` and the samples after its ``since``;
    the result is that of all samples, older ones are not read.
    """
    since = None if before is None else before.since
    how = _Setting(list(labels), step, lookback, slice_s, ts, tagged.schema[ts].dataType, as_of, since)
    timed: dict[Callable, list[Rule]] = {}
    for rule in rules:
        if rule.kind != "absent":
            timed.setdefault(EVALUATORS[rule.kind], []).append(rule)
    earlier = None if before is None else before.runs
    parts = []
    for build, chosen in timed.items():
        mine = tagged.filter(F.col("kind").isin(*sorted({r.kind for r in chosen})))
        found = build(mine, chosen, how, earlier).filter(F.col(ts) <= as_of)
        parts.append(found if since is None else found.filter(F.col(ts) > since))
    runs = None
    if parts:
        runs = run_summaries(_union(parts), how.key, F.col("condition"), ts, "value", staleness_s, slice_s, "until", earlier)
    reach = _per_rule(rules, lambda r: seconds(max(lookback.total_seconds(), r.range_s if r.kind in ("rate", "increase") else 0)))
    carry = tagged.filter(~F.col("kind").isin("absent", "gauge") & (F.col(ts) > as_of - reach))
    return Progress(as_of, runs, _last_seen(tagged, how.key, ts, None if before is None else before.last), carry)


def rule_states(
    now: Progress, rules: Sequence[Rule], labels: Sequence[str], ts: str = "ts", staleness_s: float = 300,
    lookback: timedelta = LOOKBACK, expected: DataFrame | None = None,
) -> DataFrame:
    """State of every rule and series at the time an evaluation went up to."""
    states = []
    timed = [rule for rule in rules if rule.kind != "absent"]
    if timed:
        state = states_of(now.runs, ["rule", *labels], _per_rule(timed, lambda r: F.lit(float(r.hold_s))), now.since, ts, "value", staleness_s)
        counting = [r for r in timed if r.kind == "count" and COMPARE[r.op](0.0, r.threshold)]
        if counting:
            state = _with_zero_counts(state, counting, labels, ts)
        states.append(state.drop(ts))
    silent = [rule for rule in rules if rule.kind == "absent"]
    if silent:
        states.append(_silent(now.last, silent, labels, now.since, expected))
    aged = [rule for rule in rules if rule.kind == "age"]
    if aged:
        states.append(_unseen(now.last, aged, labels, now.since, lookback))
    severity = _per_rule(rules, lambda r: F.lit(r.severity))
    return _union(states).select(
        "rule", severity.alias("severity"), *labels, "value", "active_since", "state"
    )


def evaluate_rules(
    samples: DataFrame, rules: Sequence[Rule], as_of: datetime | Column,
    labels: Sequence[str] = ("job", "instance", "name"),
    step: timedelta = timedelta(seconds=15), metric: str = "metric", ts: str = "ts",
    staleness_s: float = 300, slice_s: int = SLICE_S, expected: DataFrame | None = None,
    lookback: timedelta = LOOKBACK,
) -> DataFrame:
    """State of every rule and series at ``as_of``.

    ``samples`` carry the labels as columns; a NULL label is a label like any other.
    Count, ratio and age rules see each series' latest sample, none older than
    ``lookback``, at every multiple of ``step``; they work on stretches between
    changes, not on evaluation times. ``expected`` may list the series
    ``(rule, *labels)`` that absent rules wait for; without it a rule is absent
    when nothing matches it. Samples are read once: those that rules select are
    written to the scratch folder in order of their kind, and each kind of rule
    reads its own.
    """
    as_of = as_of if isinstance(as_of, Column) else F.lit(as_of)
    labels = list(labels)
    history = samples.filter(F.col(ts) <= as_of)
    tagged = stage(tag(history, rules, labels, metric, ts).sortWithinPartitions("kind", "rule"), "tagged")
    now = advance(tagged, rules, as_of, labels, step, ts, staleness_s, slice_s, lookback)
    return rule_states(now, rules, labels, ts, staleness_s, lookback, expected)


def _with_zero_counts(state: DataFrame, rules: Sequence[Rule], labels, ts: str) -> DataFrame:
    """A count rule that matched no sample at all counts zero, and fires."""
    zero = state.sparkSession.createDataFrame([(r.name,) for r in rules], "rule string").select(
        "rule", *[F.lit("").alias(n) for n in labels], F.lit(0.0).alias("value"),
        F.lit("firing").alias("state"),
    )
    # the zero row has no time, so any row the rule really has comes first
    return latest_per_key(
        state.unionByName(zero, allowMissingColumns=True), ["rule", *labels], [ts]
    )


def reference_rules() -> list[Rule]:
    """The monitored stack's 18 rules: names, metrics, thresholds and holds are fixed values."""
    store = {"label": "job", "regex": False}
    rules = [
        Rule("SeaweedFSNodeDown", "gauge", "up", "==", 0, 60, "critical", pattern="seaweedfs", **store),
        Rule("SeaweedFSVolumeMissing", "count", "up", "<", 1, 60, "warning", pattern="seaweedfs-volume", **store),
        Rule("SeaweedFSMasterDown", "gauge", "up", "==", 0, 30, "critical", pattern="seaweedfs-master", **store),
        Rule("SeaweedFSFilerDown", "gauge", "up", "==", 0, 30, "critical", pattern="seaweedfs-filer", **store),
        Rule("SeaweedFSVolumeHighUsage", "gauge", "weed_volume_disk_usage_percent", ">", 85, 300),
        Rule("SeaweedFSHighLatency", "gauge", "weed_filer_request_duration_seconds", ">", 1, 300),
    ]
    services = [
        ("OpenSearch", "OpenSearchNodeDown", "opensearch$", True, 0.9),
        ("OpenSearchDashboards", "OpenSearchDashboardsDown", "opensearch-dashboards$", True, 0.8),
        ("Grafana", "GrafanaDown", "grafana", False, 0.8),
    ]
    for service, down, pattern, regex, cpu in services:
        on = {"label": "name", "pattern": pattern, "regex": regex}
        rules += [
            Rule(down, "age", "container_last_seen", ">", 60, 60, "critical", **on),
            Rule(f"{service}HighCPU", "rate", "container_cpu_usage_seconds_total", ">", cpu, 600, **on),
            Rule(f"{service}HighMemory", "ratio", "container_memory_usage_bytes", ">", 0.9, 300,
                 divisor="container_spec_memory_limit_bytes", **on),
            Rule(f"{service}FrequentRestarts", "increase", "container_start_time_seconds", ">", 2, 60,
                 range_s=3600, **on),
        ]
    return rules
