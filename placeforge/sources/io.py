"""Sources and sinks: SRC1-SRC3, SRC8, SRC9, SNK1-SNK5."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from placeforge.schemas import ENRICHMENT, ENTITY

FEATURES = "features array<struct<properties:struct<STATION_NA:string,EXIT_CODE:string>,geometry:struct<coordinates:array<double>>>>"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder where driver and executors both see it; a local one only under a local master that names none."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="placeforge-")
    return f"{base}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it again: lineage ends there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def flatten_features(df: DataFrame) -> DataFrame:
    """SRC1: a row for each feature; coordinates are (lng, lat); without geometry both are 0."""
    at = lambda k: F.coalesce(F.try_element_at(F.col("f.geometry.coordinates"), F.lit(k)), F.lit(0.0))
    return df.select(F.posexplode("features").alias("ord", "f")).select(F.col("f.properties.STATION_NA").alias("station_na"), F.col("f.properties.EXIT_CODE").alias("exit_code"), at(2).alias("latitude"), at(1).alias("longitude"), "ord")


def read_documents(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """Files that hold one JSON document each: (the good ones by the schema, the broken ones as (file, document))."""
    parsed = F.from_json("value", f"{schema}, __broken string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__broken"})
    df = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("file"), F.col("value").alias("document"), parsed.alias("d"))
    broken = F.col("d").isNull() | F.col("d.__broken").isNotNull()
    return df.where(~broken).select("d.*").drop("__broken"), df.where(broken).select("file", "document")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """SRC1: of all good documents; broken ones are found by read_documents."""
    return flatten_features(read_documents(spark, path, FEATURES)[0])


def parse_geojson(text: Column) -> Column:
    return F.from_json(text, FEATURES)


SAVED_ENTITIES = f"stations array<struct<{ENTITY}>>"
SAVED_ENRICHMENT = f"stations map<string,struct<{ENRICHMENT}>>, failed_stations array<struct<station_id: string>>, skipped_stations array<struct<station_id: string>>"


def read_entities(spark: SparkSession, path: str) -> DataFrame:
    """SRC2: typed entities of saved documents; a file that is none gives no row."""
    return read_documents(spark, path, SAVED_ENTITIES)[0].select(F.explode("stations").alias("s")).select("s.*")


def read_enrichment(spark: SparkSession, path: str) -> DataFrame:
    """SRC3: (station_id, status, result): a map of results and the lists of failed and skipped ids as rows, each document read once."""
    none = F.lit(None).cast(f"struct<{ENRICHMENT}>")
    row = lambda station, status, result: F.struct(station.alias("station_id"), F.lit(status).alias("status"), result.alias("result"))
    kind = f"array<struct<station_id:string,status:string,result:struct<{ENRICHMENT}>>>"
    listed = lambda col, status: F.transform(col, lambda x: row(x["station_id"], status, none))
    parts = [F.transform(F.map_entries("stations"), lambda x: row(x["key"], "success", x["value"])), listed(F.col("failed_stations"), "failed"), listed(F.col("skipped_stations"), "skipped")]
    rows = F.concat(*[F.coalesce(p.cast(kind), F.array().cast(kind)) for p in parts])
    return read_documents(spark, path, SAVED_ENRICHMENT)[0].select(F.explode(rows).alias("x")).select("x.*")


def lookup_table(spark: SparkSession, table: dict[str, str], key: str, value: str) -> DataFrame:
    """SRC8."""
    return spark.createDataFrame(list(table.items()), f"{key} string, {value} string")


def write_entities(df: DataFrame, path: str, fmt: str = "json") -> None:
    """SNK1."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_version(df: DataFrame, base: str, version: str) -> None:
    """SNK2: rows under their data_version; the latest one is the greatest in the manifest."""
    df.withColumn("data_version", F.lit(version)).write.mode("append").partitionBy("data_version").parquet(f"{base}/data")
    df.sparkSession.createDataFrame([(version,)], "version string").write.mode("append").parquet(f"{base}/manifest")


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    version = spark.read.parquet(f"{base}/manifest").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{base}/data").where(F.col("data_version").cast("string") == version)


def write_state(ledger: DataFrame, base: str, snapshot: int) -> None:
    """SNK3: a new snapshot, then its row in the manifest: readers see whole snapshots only."""
    ledger.write.mode("overwrite").parquet(f"{base}/snapshot={snapshot}")
    ledger.sparkSession.createDataFrame([(snapshot,)], "snapshot long").write.mode("append").parquet(f"{base}-manifest")


def read_state(spark: SparkSession, base: str, below: int | None = None) -> DataFrame | None:
    """SRC9, T6: the newest snapshot with rows (numbered below `below`); of an empty one the one before; None if there is none."""
    try:
        known = sorted((r[0] for r in spark.read.parquet(f"{base}-manifest").distinct().collect()), reverse=True)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    for k in known:
        if below is not None and k >= below:
            continue
        df = spark.read.parquet(f"{base}/snapshot={k}")
        if not df.isEmpty():
            return df
    return None


def append_run(df: DataFrame, path: str) -> None:
    """SNK4."""
    df.write.mode("append").parquet(path)


def append_alerts(df: DataFrame, path: str) -> None:
    """SNK5."""
    df.withColumn("ts", F.current_timestamp()).write.mode("append").parquet(path)


