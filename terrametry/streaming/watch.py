"""Alert rules over a stream of samples."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.alerts import Progress, Rule, advance, rule_states, tag
from ..session import discard, path_exists, stage

#: Batches whose progress is kept, so that late samples go back no further than they must.
KEPT = 8


def _marks(spark: SparkSession, progress: str) -> list:
    """(batch_id, as_of) of each batch whose progress is kept, oldest first; at most ``KEPT`` and one."""
    if not path_exists(spark, f"{progress}/marks"):
        return []
    return spark.read.parquet(f"{progress}/marks").select("batch_id", "as_of").orderBy("batch_id").collect()


def rule_sink(
    history: str, states: str, rules: Sequence[Rule], labels: Sequence[str],
    horizon: timedelta | None = None, ts: str = "ts", metric: str = "metric", **how,
) -> Callable[[DataFrame, int], None]:
    """Function for ``foreachBatch``: keep samples, then evaluate the rules.

    Each batch gives the states of all samples so far as of the newest, as a batch
    job over them would, but reads only its own samples and the progress of the batch
    before: a run summary for each rule and series, the last sample of watched series, and the
    samples that windows and lookbacks still reach. The work of a batch does not grow with the
    stream's life.

    Samples that come late, not after the newest of an earlier batch, are evaluated from
    the last kept progress that is older than they are, with the stored samples after
    it; if none is (or ``horizon`` puts it out of reach), from the beginning. A
    ``horizon`` is refused where it is shorter than a rule's hold plus window.

    Samples, states and progress are stored by batch, so a replayed batch replaces
    itself. Samples without time are stored and belong to no state.
    """
    reach = max((r.hold_s + r.range_s for r in rules), default=0)
    if horizon is not None and horizon.total_seconds() < reach:
        raise ValueError(f"rules look {reach} seconds back")
    progress = f"{states}-progress"
    shown = {k: v for k, v in how.items() if k in ("staleness_s", "lookback", "expected")}
    stepped = {k: v for k, v in how.items() if k != "expected"}

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{history}/batch_id={batch_id}"
        batch.write.mode("overwrite").parquet(own)
        read = spark.read.schema(batch.schema)
        stored = read.parquet(own)
        oldest, newest = stored.agg(F.min(ts), F.max(ts)).first()
        if newest is None:
            return
        marks = [m for m in _marks(spark, progress) if m.batch_id < batch_id]
        at = max([newest, *(m.as_of for m in marks)])
        as_of = F.lit(at).cast(batch.schema[ts].dataType)
        base = next((m for m in reversed(marks) if m.as_of < oldest and (horizon is None or at - m.as_of <= horizon)), None)
        before, new = None, read.parquet(history) if marks else stored
        if base is not None:
            since = F.lit(base.as_of).cast(batch.schema[ts].dataType)
            kept = [spark.read.parquet(f"{progress}/{part}/batch_id={base.batch_id}") for part in ("runs", "last", "carry")]
            before = Progress(since, *kept)
            new = (stored if base is marks[-1] else new).filter(F.col(ts) > since)
        tagged = tag(new.filter(F.col(ts) <= as_of), rules, labels, metric, ts)
        if before is not None:
            tagged = tagged.unionByName(before.carry)
        now = advance(stage(tagged.sortWithinPartitions("kind", "rule"), "tagged"), rules, as_of, labels, ts=ts, before=before, **stepped)
        for part in ("runs", "last", "carry"):
            rows = getattr(now, part)
            if rows is not None:
                rows.write.mode("overwrite").parquet(f"{progress}/{part}/batch_id={batch_id}")
        written = Progress(as_of, *(
            spark.read.parquet(f"{progress}/{part}/batch_id={batch_id}") if getattr(now, part) is not None else None
            for part in ("runs", "last", "carry")))
        rule_states(written, rules, labels, ts, **shown).withColumn("as_of", as_of).write.mode("overwrite").parquet(
            f"{states}/batch_id={batch_id}")
        spark.range(1).select(as_of.alias("as_of")).write.mode("overwrite").parquet(f"{progress}/marks/batch_id={batch_id}")
        for old in marks[:-KEPT]:
            for part in ("marks", "runs", "last", "carry"):
                discard(spark, f"{progress}/{part}/batch_id={old.batch_id}")

    return write
