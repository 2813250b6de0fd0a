"""Enrichment merged onto entities at two levels: J6-J9, J18, A5, SNK6."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions import scalars as S

FIELDS = ("platforms", "accessibility", "bus_stops", "nearby_landmarks")


def drop_skipped(entities: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """J6."""
    return entities.join(ledger.where("status = 'skipped'").select(key).distinct(), key, "left_anti")


def merged_exits(exits: Column, enriched: Column, fields: tuple[str, ...] = FIELDS, retrim: bool = True, keep_empty: bool = False) -> Column:
    """Exits with the fields of the last enriched exit of the same normalised code, where not empty; both are arrays of one row.

    Exits without a code go unless keep_empty (the older form, in which empty codes match each other).
    """
    key = lambda e: S.exit_key(e["exit_code"], retrim)
    own = exits if keep_empty else F.filter(exits, lambda e: key(e) != "")

    def one(e: Column) -> Column:
        m = F.try_element_at(F.filter(enriched, lambda x: key(x) == key(e)), F.lit(-1))
        return F.struct(e["exit_code"].alias("exit_code"), e["lat"].alias("lat"), e["lng"].alias("lng"), *[S.nonempty(m[f]).alias(f) for f in fields])

    return F.transform(own, one)


def lines_served(enriched: Column) -> Column:
    """A5."""
    lines = F.flatten(F.transform(enriched, lambda e: F.transform(F.coalesce(e["platforms"], F.array().cast("array<struct<platform_code:string,towards_code:string,line_code:string>>")), lambda p: p["line_code"])))
    return S.sorted_set(F.filter(lines, lambda x: x.isNotNull() & (x != "")))


def merge_entities(entities: DataFrame, enrichment: DataFrame, key: str = "station_id", retrim: bool = True, keep_empty: bool = False) -> DataFrame:
    """J7, J8, A5 in one shuffle: enrichment (key, extraction_result, exits, accessibility_notes, extraction_timestamp) counts only
    where it succeeded; entities without one keep their own columns."""
    e = enrichment.select(key, F.struct("extraction_result", "exits", "accessibility_notes", "extraction_timestamp").alias("__e"))
    joined = entities.join(e, key, "left")
    ok = F.col("__e.extraction_result") == "success"
    rich = F.when(ok, F.col("__e.exits"))
    none = F.array().cast(enrichment.schema["exits"].dataType)
    return (
        joined.withColumn("exits", merged_exits(F.col("exits"), F.coalesce(rich, none), retrim=retrim, keep_empty=keep_empty))
        .withColumn("lines_served", F.when(ok, lines_served(F.col("__e.exits"))))
        .withColumn("accessibility_notes", F.when(ok, S.nonempty(F.col("__e.accessibility_notes"))))
        .withColumn("enrichment_last_updated", F.when(ok, F.col("__e.extraction_timestamp")))
        .drop("__e")
    )


def merge_by_name(entities: DataFrame, enrichment: DataFrame) -> DataFrame:
    """J18."""
    return merge_entities(entities, enrichment, key="official_name", retrim=False, keep_empty=True)


def unmatched_enrichment(exits: DataFrame, enriched: DataFrame, key: str) -> DataFrame:
    """Enriched exits (key, exit_code, ..) without an exit of the same normalised code."""
    own = exits.select(key, S.exit_key(F.col("exit_code")).alias("__k")).distinct()
    return enriched.withColumn("__k", S.exit_key(F.col("exit_code"))).join(own, [key, "__k"], "left_anti").drop("__k")


def platform_edges(enrichment: DataFrame, key: str = "station_id") -> DataFrame:
    """SNK6: one row for each platform."""
    return enrichment.select(key, F.explode("exits").alias("e")).select(key, F.col("e.exit_code").alias("exit_code"), F.explode("e.platforms").alias("p")).select(key, "exit_code", "p.line_code", "p.platform_code", "p.towards_code")
