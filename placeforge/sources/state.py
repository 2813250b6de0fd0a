"""The ledger's state in buckets, written batch by batch, and how it is recovered (SNK3, T13, SRC9, T6)."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.operators import ledger as L


def _bucket(key: str, buckets: int):
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _there(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at a path; None where there is none, or none that can be read."""
    try:
        df = spark.read.parquet(path)
        df.isEmpty()
        return df
    except Exception as e:
        if any(x in str(e) for x in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "is not a Parquet file", "CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE")):
            return None
        raise


def _map(spark: SparkSession, base: str, below: int | None) -> dict[int, int]:
    """Of each bucket the version that holds it, as the newest map (below a version) says; a map has a row for each bucket."""
    known = _there(spark, f"{base}/map")
    if known is None:
        return {}
    known = known if below is None else known.where(F.col("version") < below)
    newest = known.agg(F.max("version")).first()[0]
    return {} if newest is None else {r.bucket: r.held for r in known.where(F.col("version") == newest).collect()}


def _buckets(spark: SparkSession, base: str, held: dict[int, int]) -> DataFrame | None:
    paths = [f"{base}/data/version={v}/bucket={b}" for b, v in sorted(held.items())]
    return spark.read.option("basePath", f"{base}/data").parquet(*paths).drop("version", "bucket") if paths else None


def read_buckets(spark: SparkSession, base: str, below: int | None = None) -> DataFrame | None:
    """The whole ledger as the newest version (below one) left it; None if there is none."""
    return _buckets(spark, base, _map(spark, base, below))


def upsert_buckets(batch: DataFrame, base: str, version: int, key: str = "entity_id", order: tuple[str, ...] = ("ts",), buckets: int = 64, keep: int = 16) -> list[int]:
    """T1 applied to the buckets that a batch touches; they are written under its version, then a map that points to them and else to what the
    map below it says. Returns the touched buckets.

    A version that is given twice is worked out from the same map and written over, so a replayed batch changes nothing. The map has a row for
    each bucket, whatever the ledger holds; every `keep` versions what no map of the last `keep` points to is removed.
    """
    spark = batch.sparkSession
    held = _map(spark, base, version)
    batch = batch.where(F.col(key).isNotNull()).withColumn("bucket", _bucket(key, buckets))
    touched = sorted(r[0] for r in batch.select("bucket").distinct().collect())  # at most `buckets` rows
    before = _buckets(spark, base, {b: held[b] for b in touched if b in held})
    after = L.apply_outcomes(before, batch.drop("bucket"), key, order).withColumn("bucket", _bucket(key, buckets))
    after.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{base}/data/version={version}")
    held |= {b: version for b in touched}
    spark.createDataFrame(sorted(held.items()), "bucket int, held long").coalesce(1).write.mode("overwrite").parquet(f"{base}/map/version={version}")
    if version and version % keep == 0:
        _prune(spark, base, version - keep)
    return touched


def _prune(spark: SparkSession, base: str, upto: int) -> None:
    """Removes maps below `upto`, and buckets that neither its map nor a later one points to."""
    known = spark.read.parquet(f"{base}/map")
    live = {(r.held, r.bucket) for r in known.where(F.col("version") >= upto).select("held", "bucket").distinct().collect()}  # at most `buckets` for each kept version
    fs = spark._jvm.org.apache.hadoop.fs.Path(base).getFileSystem(spark._jsc.hadoopConfiguration())
    path = lambda *x: spark._jvm.org.apache.hadoop.fs.Path("/".join((base, *x)))
    number = lambda p: int(p.getPath().getName().split("=")[1])
    for x in fs.listStatus(path("map")):
        if x.isDirectory() and number(x) < upto:
            fs.delete(x.getPath(), True)
    for x in fs.listStatus(path("data")):
        if x.isDirectory() and number(x) < upto:
            own = [y for y in fs.listStatus(x.getPath()) if y.isDirectory()]
            dead = [y for y in own if (number(x), number(y)) not in live]
            for y in [x] if len(dead) == len(own) else dead:
                fs.delete(y.getPath(), True)


class Saved(NamedTuple):
    """A saved state: the ids that are processed, and the rows (id, status) of its results; each None where it is not there or can't be read."""

    processed: DataFrame | None
    results: DataFrame | None


def write_saved(processed: DataFrame, results: DataFrame, base: str) -> None:
    processed.write.mode("overwrite").parquet(f"{base}/processed")
    results.write.mode("overwrite").parquet(f"{base}/results")


def read_saved(spark: SparkSession, base: str) -> Saved:
    return Saved(_there(spark, f"{base}/processed"), _there(spark, f"{base}/results"))


#: The states of results, in the order in which they count.
STATES = ("success", "failed", "skipped")


def _rebuilt(saved: Saved, key: str) -> DataFrame | None:
    """The processed ids that a state's results tell."""
    if saved.results is None:
        return None
    return L.rebuild_processed([(s, saved.results.where(F.col("status") == s)) for s in STATES], key)


def recover(main: Saved, backup: Saved, final: Saved, key: str = "entity_id") -> tuple[str, DataFrame] | None:
    """SRC9, T6: (which link held, (id, state)) of the first link with a processed id: the main state as it is; the backup, whose ids are rebuilt
    from its results where it names none; the main state's ids rebuilt; the final output's. A state is null where the results don't say it.
    """
    some = lambda df: df is not None and not df.isEmpty()

    def as_it_is(saved: Saved) -> DataFrame | None:
        if not some(saved.processed):
            return None
        own = saved.processed.where(F.col(key).isNotNull()).select(key).distinct()
        states = _rebuilt(saved, key)
        return own.withColumn("state", F.lit(None).cast("string")) if states is None else own.join(states, key, "left")

    links = (("main", lambda: as_it_is(main)), ("backup", lambda: as_it_is(backup) or _rebuilt(backup, key)), ("rebuilt", lambda: _rebuilt(main, key)), ("final", lambda: _rebuilt(final, key)))
    for name, link in links:
        df = link()
        if some(df):
            return name, df
    return None
