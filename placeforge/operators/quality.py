"""Rules, reports, digests, alerts: V1-V8, A6-A16, P5."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions import scalars as S


def check_rules(df: DataFrame, rules: dict[str, str], out: str = "violations") -> DataFrame:
    """V1: the names of rules that a row breaks; a null verdict breaks."""
    return df.withColumn(out, F.array_compact(F.array(*[F.when(~F.coalesce(F.expr(rule), F.lit(False)), F.lit(name)) for name, rule in rules.items()])))


def quarantine(df: DataFrame, rules: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    """V6: (good rows, bad rows with their violations)."""
    checked = check_rules(df, rules)
    return checked.where(F.size("violations") == 0).drop("violations"), checked.where(F.size("violations") > 0)


def check_output(df: DataFrame, rules: dict[str, str], least: int = 1) -> DataFrame:
    """V2: one row: n_rows, n_invalid, passed."""
    return check_rules(df, rules).agg(F.count("*").alias("n_rows"), F.count_if(F.size("violations") > 0).alias("n_invalid")).withColumn("passed", (F.col("n_rows") >= least) & (F.col("n_invalid") == 0))


def completeness(df: DataFrame, expected: int, fields: list[str]) -> DataFrame:
    """V3: one row: n_rows, shortfall, n_missing (rows that lack a field)."""
    return df.agg(F.count("*").alias("n_rows"), F.greatest(F.lit(expected) - F.count("*"), F.lit(0)).alias("shortfall"), F.count_if(F.size(S.missing(fields)) > 0).alias("n_missing"))


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """A7."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


def sanity(df: DataFrame, key: str, lat: str = "lat", lng: str = "lng", bounds: tuple = S.BOUNDS) -> DataFrame:
    """V4: one row: n_out_of_bounds, n_duplicate_keys."""
    out = df.agg(F.count_if(~S.in_bounds(F.col(lat), F.col(lng), bounds)).alias("n_out_of_bounds"))
    return out.crossJoin(duplicate_keys(df, key).agg(F.count("*").alias("n_duplicate_keys")))  # one row each


def quality_report(df: DataFrame, exits: str, lat: str, lng: str, fields: list[str], bounds: tuple = S.BOUNDS) -> DataFrame:
    """Totals in one pass; exits is the number of a row's exits."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(F.col(exits) > 0).alias("with_exits"),
        F.count_if(F.coalesce(F.col(exits), F.lit(0)) == 0).alias("without_exits"),
        F.coalesce(F.sum(exits), F.lit(0)).cast("long").alias("total_exits"),
        F.count_if(~S.in_bounds(F.col(lat), F.col(lng), bounds)).alias("out_of_range"),
        F.count_if(F.size(S.missing(fields)) > 0).alias("missing_fields"),
    )


def merge_summary(merged: DataFrame, n_in: Column, ts: str = "enrichment_last_updated") -> DataFrame:
    """A6."""
    return merged.agg(F.count("*").alias("total"), F.count(ts).alias("enriched")).withColumn("skipped", n_in - F.col("total"))


def coverage(df: DataFrame, ok: Column, least: float = 0.7) -> DataFrame:
    """A10."""
    share = F.coalesce(F.try_divide(F.count_if(ok), F.count("*")), F.lit(0.0))
    return df.agg(F.round(share, 6).alias("coverage"), (share < least).alias("warn"))


def status_summary(ledger: DataFrame) -> DataFrame:
    """A12."""
    return ledger.agg(F.count_if(F.col("status") == "success").alias("success"), F.count_if((F.col("status") == "failed") & F.col("permanent")).alias("permanent_failures"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.count("*").alias("total"))


def extraction_metrics(df: DataFrame) -> DataFrame:
    """Rows (content_ok, llm_ok booleans, confidence, n_exits, size_before, size_after). Any other confidence counts as low."""
    rate = lambda x: F.round(F.coalesce(F.try_divide(x * 100.0, F.count("*")), F.lit(0.0)), 1)
    ok = F.col("llm_ok")
    return df.agg(
        F.count("*").alias("total"),
        F.count_if("content_ok").alias("content_ok"),
        F.count_if(~F.col("content_ok")).alias("content_failed"),
        F.count_if(ok).alias("llm_ok"),
        F.count_if(~ok).alias("llm_failed"),
        rate(F.count_if("content_ok")).alias("content_rate"),
        rate(F.count_if(ok)).alias("llm_rate"),
        F.count_if(ok & (F.col("confidence") == "high")).alias("high"),
        F.count_if(ok & (F.col("confidence") == "medium")).alias("medium"),
        F.count_if(ok & ~F.coalesce(F.col("confidence").isin("high", "medium"), F.lit(False))).alias("low"),
        rate(F.count_if(F.col("n_exits") == 0)).alias("empty_exit_rate"),
        F.round(F.avg("size_before"), 1).alias("avg_before"),
        F.round(F.avg("size_after"), 1).alias("avg_after"),
        F.round(F.coalesce(F.try_divide((F.sum("size_before") - F.sum("size_after")) * 100.0, F.sum("size_before")), F.lit(0.0)), 1).alias("reduction_percent"),
        F.when(F.count("*") == 0, "no rows").alias("message"),
    )


def enrichment_stats(exits: DataFrame) -> DataFrame:
    """Rows are exits with the four lists."""
    has = lambda c: F.count_if(F.coalesce(F.size(c), F.lit(0)) > 0)
    return exits.agg(F.count("*").alias("exits_total"), has("platforms").alias("with_platforms"), has("accessibility").alias("with_accessibility"), has("bus_stops").alias("with_bus_stops"))


def count_check(df: DataFrame, expected: Column | int) -> DataFrame:
    """N, mismatch (not exact), shortfall (below)."""
    e = expected if isinstance(expected, Column) else F.lit(expected)
    return df.agg(F.count("*").alias("n")).select("n", (F.col("n") != e).alias("mismatch"), (F.col("n") < e).alias("shortfall"))


def change_counts(before: DataFrame, after: DataFrame, key: str, cols: list[str]) -> DataFrame:
    """One row: added, removed, changed."""
    b = before.select(key, F.struct(*cols).alias("b"))
    a = after.select(key, F.struct(*cols).alias("a"))
    return b.join(a, key, "full").agg(F.count_if(F.col("b").isNull()).alias("added"), F.count_if(F.col("a").isNull()).alias("removed"), F.count_if(F.col("b").isNotNull() & F.col("a").isNotNull() & (F.col("a") != F.col("b"))).alias("changed"))


def dataset_digest(df: DataFrame, canonical: Column) -> DataFrame:
    """(digest, n_bytes): rows' hashes in 256 x 256 buckets, each bucket's hash over its sorted rows, two more levels above.

    A bucket holds one of 65,536 parts of the rows; the levels above have at most 256 hashes in a group.
    """
    rows = df.select(F.sha2(canonical, 256).alias("h"), F.octet_length(canonical).cast("long").alias("n"))
    level = rows.groupBy(F.substring("h", 1, 4).alias("k"), "h").agg(F.count("*").alias("c"), F.sum("n").alias("n"))
    level = level.groupBy("k").agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "h", "c"))), ""), 256).alias("h"), F.sum("n").alias("n"))
    level = level.groupBy(F.substring("k", 1, 2).alias("k")).agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "h"))), lambda x: x["h"]), ""), 256).alias("h"), F.sum("n").alias("n"))
    return level.agg(F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("k", "h"))), lambda x: x["h"]), ""), 256).alias("digest"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_bytes"))


def package_check(df: DataFrame, canonical: Column, expected: int, digest: str | None = None, max_bytes: int = 5 << 20) -> DataFrame:
    """V7."""
    d = dataset_digest(df, canonical).crossJoin(df.agg(F.count("*").alias("n")))  # one row each
    return d.select((F.col("n_bytes") <= max_bytes).alias("size_ok"), (F.col("n") == expected).alias("count_ok"), (F.lit(True) if digest is None else F.col("digest") == digest).alias("digest_ok"))


def check_metadata(metadata: Column, required: list[str]) -> Column:
    """V5: required keys that a map lacks."""
    return F.array_except(F.array(*map(F.lit, required)), F.map_keys(metadata))


def alert_rules(metrics: DataFrame) -> DataFrame:
    """V8: metrics (coverage, n, expected, stage_failed) to alert rows (level, message)."""
    alerts = F.array_compact(
        F.array(
            F.when(F.col("coverage") < 0.7, F.struct(F.lit("warning").alias("level"), F.lit("coverage below 70 %").alias("message"))),
            F.when(F.col("n") < F.col("expected"), F.struct(F.lit("error").alias("level"), F.lit("fewer rows than expected").alias("message"))),
            F.when(F.col("stage_failed"), F.struct(F.lit("critical").alias("level"), F.lit("a stage failed").alias("message"))),
        )
    )
    return metrics.select(F.explode(alerts).alias("a")).select("a.*")


def alert_counts(alerts: DataFrame) -> DataFrame:
    """A13."""
    level = lambda x: F.count_if(F.col("level") == x).alias(x)
    return alerts.agg(F.count("*").alias("total"), level("info"), level("warning"), level("error"), level("critical"), F.coalesce(F.bool_or(F.col("level") == "critical"), F.lit(False)).alias("any_critical"))
