"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

import uuid

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space in the sense of the contracts: blank and the characters 9 to 13.
SPACE = r"\x20\x09-\x0D"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share. Only where the cluster names none (tests), a local one is taken."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    import tempfile

    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not hasattr(spark.sparkContext, "_placeforge_dir"):
        spark.sparkContext._placeforge_dir = "file://" + tempfile.mkdtemp(prefix="placeforge-")
    return spark.sparkContext._placeforge_dir


def cut(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it again: lineage ends there and a lost executor loses nothing."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_hash: bool = False) -> DataFrame:
    """Only `doc_id` and the text as UTF-8 bytes (null: empty), so columns that operators add can't clash with the input's."""
    text = F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), *([F.xxhash64(text).alias("h")] if with_hash else []))


def drop_rows(docs: DataFrame, named: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` without the rows that `named` (doc_id, h, group, kept) names as not kept; its other rows stay, of each group only one: the first as JSON.

    Rows that nothing names stay as they are. Only where several rows of a group are kept (a repeated doc_id) is there a second pass.
    """
    tied = named.where("kept").groupBy("group").agg(F.count("*").alias("n"), F.min("doc_id").alias("doc_id"), F.min("h").alias("h")).where("n > 1").select("group", "doc_id", "h")
    ties = not tied.isEmpty()
    own = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(id_col).cast("long").alias("d"), F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b""))).alias("x"))

    def same(other: DataFrame):
        return own["d"].eqNullSafe(other["doc_id"]) & (own["x"] == other["h"])

    gone = named.where("not kept").select("doc_id", "h")
    if ties:
        gone = gone.unionByName(named.where("kept").join(tied.select("group"), "group", "left_semi").select("doc_id", "h"))
    gone = gone.distinct()
    rest = own.join(gone, same(gone), "left_anti").select("row.*")
    if ties:
        rest = rest.unionByName(own.join(tied, same(tied)).groupBy("group").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*"))
    return rest


def whole_groups(batches, keys: int):
    """The rows as arrays of longs, cut only between groups that agree on the first `keys` columns; the batches are sorted by these."""
    import numpy as np

    rest = None
    for x in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in x.columns], axis=1)
        rest = rows if rest is None else np.concatenate([rest, rows])
        new = np.nonzero((rest[1:, :keys] != rest[:-1, :keys]).any(axis=1))[0]
        if len(new):
            yield rest[: new[-1] + 1]
            rest = rest[new[-1] + 1 :]
    if rest is not None and len(rest):
        yield rest


def groups(batches, keys: int):
    """Runs of rows that agree on the first `keys` columns, as arrays of longs; the batches are sorted by these. A run may span batches."""
    import numpy as np

    for rows in whole_groups(batches, keys):
        yield from np.split(rows, np.nonzero((rows[1:, :keys] != rows[:-1, :keys]).any(axis=1))[0] + 1)


#: Items of an array that are folded at once, and bits of a table of marks.
BLOCK, BITS = 256, 18


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value), with the value worked out once: a lambda that names an expression works it out for each element."""
    return F.transform(F.array(value), use)[0]


def running(items: Column, step: Callable[[Column, Column], Column], emit: Callable[[Column, Column], Column], kind: str, zero: Column | None = None, state: str = "int") -> Column:
    """Array (of type `kind`) of emit(at, x), `at` being what `step` has made of `zero` (of type `state`; by default 0) and the items before x.

    Folds work in blocks, whose first values come from a fold over blocks, so an array of a million items isn't copied for each of them.
    """
    none, zero = F.array().cast(kind), (F.lit(0) if zero is None else zero).cast(state)

    def within(part: Column, at: Column) -> Column:
        return F.aggregate(part, F.struct(at.alias("at"), none.alias("out")), lambda a, x: F.struct(step(a["at"], x).cast(state).alias("at"), F.concat(a["out"], F.array(emit(a["at"], x)).cast(kind)).alias("out")))["out"]

    def over(parts: Column) -> Column:
        start = F.struct(zero.alias("at"), F.array().cast(f"array<{state}>").alias("firsts"))
        last = lambda p, at: F.aggregate(p, at, lambda a, x: step(a, x).cast(state))
        firsts = F.aggregate(parts, start, lambda a, p: F.struct(last(p, a["at"]).alias("at"), F.concat(a["firsts"], F.array(a["at"])).alias("firsts")))["firsts"]
        return F.flatten(F.zip_with(parts, firsts, within))

    def split(x: Column) -> Column:
        parts = F.transform(F.sequence(F.lit(0), ((F.size(x) - 1) / BLOCK).cast("int")), lambda i: F.slice(x, i * BLOCK + 1, F.lit(BLOCK)))
        return F.when(F.size(x) > 0, bound(parts, over)).otherwise(none)

    return bound(items, split)


def marks(df: DataFrame, col: str) -> Callable[[Column], Column]:
    """A test that is true for every value of a column, and for few others while these are fewer than its 2**BITS bits, whatever the corpus."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << BITS)).cast("int")
    told = df.select(place(F.col(col)).alias("p")).groupBy(F.shiftright("p", 5).alias("at")).agg(F.bit_or(F.expr("shiftleft(1L, p % 32)")).alias("bits")).collect()  # at most 2**BITS / 32 rows
    table = [0] * (1 << BITS - 5)
    for at, bits in told:
        table[at] = bits
    held = F.split(F.lit(",".join(map(str, table))), ",").cast("array<bigint>")
    return lambda c: F.call_function("shiftright", F.get(held, F.shiftright(place(c), 5)), place(c) % 32).bitwiseAND(F.lit(1)) == 1
