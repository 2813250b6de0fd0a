"""Rules of nested fields, compiled to rows that name the place of each violation."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

Rules = dict[str, Callable[[Column], Column]]
FOUND = "array<struct<path:string,value:string>>"


def _kind(kind: T.DataType, steps: list[str]) -> T.DataType:
    """The type at a path; a step that the schema lacks is an error."""
    for s in steps:
        if s == "[]":
            if not isinstance(kind, T.ArrayType):
                raise ValueError(f"[] of {kind.simpleString()}")
            kind = kind.elementType
        else:
            if not isinstance(kind, T.StructType) or s not in kind.names:
                raise ValueError(f"{s!r} is no field of {kind.simpleString()}")
            kind = kind[s].dataType
    return kind


def _steps(path: str) -> list[str]:
    return [x for part in path.split(".") for x in ((part.removesuffix("[]"), "[]") if part.endswith("[]") else (part,)) if x]


def compiled(schema: T.StructType, rules: Rules) -> Column:
    """An array of (path, value) of all violations: rules by path (`exits[].bus_stops[].code`), each a test that must not be false or null.

    Places in arrays are numbered from 0, as in `exits[2].bus_stops[0].code`. What lies in a null array or struct is not there, and so breaks
    nothing but the rules of that array or struct itself.
    """

    def walk(value: Column, steps: list[str], at: Column, test: Callable[[Column], Column], inside: bool) -> Column:
        if not steps:
            return F.when(~F.coalesce(test(value), F.lit(False)), F.array(F.struct(at.alias("path"), value.cast("string").alias("value")))).otherwise(F.array()).cast(FOUND)
        step, *rest = steps
        if step == "[]":
            each = F.flatten(F.transform(value, lambda x, i: walk(x, rest, F.concat(at, F.lit("["), i.cast("string"), F.lit("]")), test, True)))
            return F.coalesce(each, F.array().cast(FOUND))
        own = walk(value[step], rest, F.concat(at, F.lit(f".{step}")), test, True)
        return F.when(value.isNull(), F.array().cast(FOUND)).otherwise(own) if inside else own

    out = []
    for path, test in rules.items():
        first, *rest = _steps(path)
        _kind(schema, [first, *rest])
        out.append(walk(F.col(first), rest, F.lit(first), test, True) if rest and rest[0] != "[]" else walk(F.col(first), rest, F.lit(first), test, False))
    return F.concat(*out) if out else F.array().cast(FOUND)


def violations(df: DataFrame, key: str, rules: Rules) -> DataFrame:
    """(key, path, value), a row for each violation."""
    return df.select(key, F.explode(compiled(df.schema, rules)).alias("v")).select(key, "v.path", "v.value")


def violation_counts(found: DataFrame) -> DataFrame:
    """(rule, n): how often each path is broken, whatever the place in an array."""
    return found.groupBy(F.regexp_replace("path", r"\[[0-9]+\]", "[]").alias("rule")).agg(F.count("*").alias("n"))
