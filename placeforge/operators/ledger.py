"""The ledger of processed entities: T1-T11, U2-U5, W3, W5, J14."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from placeforge.operators.consolidate import dedupe_first

STATE = ("status", "permanent", "attempts", "error", "reason", "ts")


def latest_state(attempts: DataFrame, key: str = "entity_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The last row of each entity, combined before the shuffle."""
    rest = [c for c in attempts.columns if c != key]
    return attempts.groupBy(key).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("r")).select(key, "r.*")


def apply_outcomes(ledger: DataFrame | None, batch: DataFrame, key: str = "entity_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The last row of each entity by `order`; a failure's attempts are the sum since the last success or skip that either table holds.

    Both have the same columns, `status` and `attempts` among them; no ledger is an empty one. Of rows that tie the batch's stays. Where a
    success comes later than newer failures, those that the ledger has summed already stay counted.
    """
    both = batch.withColumn("__new", F.lit(1))
    if ledger is not None:
        both = ledger.withColumn("__new", F.lit(0)).unionByName(both)
    place = F.struct(*order, "__new")
    failed = F.col("status") == "failed"
    done = both.where(~failed).groupBy(key).agg(F.max(place).alias("__done"))
    tries = both.where(failed).withColumn("__place", place).join(done, key, "left").where("__done is null or __place > __done").groupBy(key).agg(F.sum("attempts").cast("int").alias("__n"))
    joined = latest_state(both, key, (*order, "__new")).join(tries, key, "left")
    return joined.withColumn("attempts", F.when(failed, F.col("__n")).otherwise(F.col("attempts"))).drop("__new", "__n")


def unprocessed(entities: DataFrame, ledger: DataFrame, key: str = "entity_id") -> DataFrame:
    """Neither done nor failed for good."""
    return entities.join(ledger.where("status in ('success', 'skipped') or permanent").select(key), key, "left_anti")


def select_pending(entities: DataFrame, ledger: DataFrame, mode: str, key: str = "entity_id") -> DataFrame:
    """Fresh: all; resume: J14; retry: what failed, too, for good or not."""
    if mode == "fresh":
        return entities
    if mode == "resume":
        return unprocessed(entities, ledger, key)
    if mode == "retry":
        return entities.join(ledger.where("status in ('success', 'skipped')").select(key), key, "left_anti")
    raise ValueError(f"unknown mode {mode!r}")


def reset_failed(ledger: DataFrame) -> DataFrame:
    """T3."""
    failed = F.col("status") == "failed"
    return ledger.withColumn("permanent", F.when(failed, False).otherwise(F.col("permanent"))).withColumn("retry_attempted", failed)


def number_attempts(attempts: DataFrame, key: str = "entity_id", order: tuple[str, ...] = ("ts",), delay_s: int = 5, max_retries: int = 3) -> DataFrame:
    """attempt_no from 0, next_retry_at = ts + delay 2^k, permanent and error from max_retries on."""
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1
    df = attempts.withColumn("attempt_no", n)
    wait = F.make_interval(secs=(F.lit(delay_s) * F.pow(F.lit(2.0), F.least("attempt_no", F.lit(30)))).cast("decimal(18,6)"))
    done = F.col("attempt_no") >= max_retries
    return df.withColumn("next_retry_at", F.col("ts") + wait).withColumn("permanent", done).withColumn("error", F.when(done, F.concat(F.lit("Failed after "), F.lit(max_retries).cast("string"), F.lit(" retry attempts"))))


def rebuild_processed(parts: list[tuple[str, DataFrame]], key: str = "entity_id") -> DataFrame:
    """Ids of the states in their order, each once: (id, state of its first)."""
    both = None
    for k, (state, df) in enumerate(parts):
        one = df.select(key, F.lit(state).alias("state"), F.lit(k).alias("k"))
        both = one if both is None else both.unionByName(one)
    return both.where(F.col(key).isNotNull()).groupBy(key).agg(F.min_by("state", "k").alias("state"))


def dedupe_skipped(skipped: DataFrame, key: str = "entity_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """Of an entity's skips the first stays; those without an id go."""
    return dedupe_first(skipped, [key], [F.col(c) for c in order])


def overlap(a: DataFrame, b: DataFrame, key: str = "entity_id") -> DataFrame:
    """U2."""
    return a.select(key).intersect(b.select(key))


def resolve_overlap(done: DataFrame, skipped: DataFrame, key: str = "entity_id") -> DataFrame:
    """Skipped wins."""
    return done.join(skipped.select(key), key, "left_anti")


def drop_recovered_failures(failed: DataFrame, done: DataFrame, key: str = "entity_id", order: tuple[str, ...] = ("ts",)) -> DataFrame:
    """The last failure of each entity that did not succeed."""
    return latest_state(failed.join(done.select(key).distinct(), key, "left_anti"), key, order)


def requeue_skipped(ledger: DataFrame, error: str = "Requeued after skip") -> DataFrame:
    """T10."""
    own = F.col("status") == "skipped"
    return ledger.withColumn("error", F.when(own, error).otherwise(F.col("error"))).withColumn("permanent", F.when(own, False).otherwise(F.col("permanent"))).withColumn("status", F.when(own, "failed").otherwise(F.col("status")))


def forget(ledger: DataFrame, ids: DataFrame, key: str = "entity_id") -> DataFrame:
    """T11."""
    return ledger.join(ids.select(key), key, "left_anti")


def broken_disjointness(states: DataFrame, key: str = "entity_id") -> DataFrame:
    """Entities with more than one status."""
    return states.groupBy(key).agg(F.count_distinct("status").alias("n_status")).where("n_status > 1")
