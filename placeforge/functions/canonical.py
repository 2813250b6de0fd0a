"""Canonical JSON of typed values: keys sorted at every level, nothing between them, ASCII only."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Characters with an escape of their own.
ESCAPES = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t", "\f": "\\f", "\b": "\\b"}


def _quoted(s: Column) -> Column:
    """A string; what is not printable ASCII as four hexadecimal digits for each UTF-16 unit."""
    units = lambda c: F.regexp_replace(F.lower(F.hex(F.encode(c, "UTF-16BE"))), "(.{4})", r"\\u$1")

    def escaped(c: Column) -> Column:
        out = F
        for plain, given in ESCAPES.items():
            out = out.when(c == plain, given)
        return out.when(~c.rlike("^[ -~]$"), units(c)).otherwise(c)

    chars = F.transform(F.regexp_extract_all(s, F.lit(r"([\s\S])"), F.lit(1)), escaped)
    return F.concat(F.lit('"'), F.when(s.rlike(r'[^ !#-\[\]-~]'), F.array_join(chars, "")).otherwise(s), F.lit('"'))


def _real(x: Column) -> Column:
    """The shortest digits that tell a double: plain from 0.0001 to below 10**16, else with an exponent of two digits at least."""
    text = x.cast("string")
    plain = F.regexp_replace(F.regexp_replace(x.cast("decimal(38,22)").cast("string"), "0+$", ""), r"\.$", ".0")
    sign = F.when(text.contains("E-"), "-").otherwise("+")
    power = F.regexp_extract(text, "E-?([0-9]+)$", 1)
    far = F.concat(F.regexp_replace(F.regexp_extract(text, "^(.*)E", 1), r"\.0$", ""), F.lit("e"), sign, F.when(F.length(power) < 2, F.lpad(power, 2, "0")).otherwise(power))
    return F.when(~text.contains("E"), text).when(F.abs(x).between(1e-4, 9999999999999998.0), plain).otherwise(far)


def canonical_json(value: Column, kind: T.DataType, without: frozenset[str] = frozenset()) -> Column:
    """A value of a type as JSON; struct fields named in `without` are left out at every level. Nulls are written; times and dates as strings."""
    if isinstance(kind, T.StructType):
        fields = sorted((f for f in kind.fields if f.name not in without), key=lambda f: f.name)
        parts = [F.concat(_quoted(F.lit(f.name)), F.lit(":"), canonical_json(value[f.name], f.dataType, without)) for f in fields]
        out = F.when(value.isNotNull(), F.concat(F.lit("{"), F.concat_ws(",", *parts) if parts else F.lit(""), F.lit("}")))
    elif isinstance(kind, T.ArrayType):
        out = F.concat(F.lit("["), F.array_join(F.transform(value, lambda x: canonical_json(x, kind.elementType, without)), ","), F.lit("]"))
    elif isinstance(kind, T.MapType):
        entry = lambda e: F.concat(_quoted(e["key"].cast("string")), F.lit(":"), canonical_json(e["value"], kind.valueType, without))
        out = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.map_entries(value)), entry), ","), F.lit("}"))
    elif isinstance(kind, (T.DoubleType, T.FloatType)):
        out = _real(value)
    elif isinstance(kind, (T.IntegralType, T.BooleanType, T.DecimalType)):
        out = value.cast("string")
    else:
        out = _quoted(value.cast("string"))
    return F.coalesce(out, F.lit("null"))


def sealed(document: Column, kind: T.StructType, size: str = "file_size_bytes", checksum: str = "checksum_sha256") -> tuple[Column, Column]:
    """(size, checksum) of a document whose `metadata` struct has both fields: the bytes of its canonical JSON without the checksum and with 0 for
    the size, and the SHA-256 of it with the size in."""
    metadata = kind["metadata"].dataType
    with_size = lambda n: F.struct(*[F.struct(*[(n if f.name == size else document["metadata"][f.name]).alias(f.name) for f in metadata.fields]).alias("metadata") if x.name == "metadata" else document[x.name].alias(x.name) for x in kind.fields])
    text = lambda n: canonical_json(with_size(n), kind, frozenset([checksum]))
    n_bytes = F.octet_length(text(F.lit(0).cast("long"))).cast("long")
    return n_bytes, F.sha2(text(n_bytes), 256)


def check_sealed(document: Column, kind: T.StructType, checksum: str = "checksum_sha256") -> Column:
    """Whether a document's checksum is that of its canonical JSON without it; null where it has none."""
    return document["metadata"][checksum] == F.sha2(canonical_json(document, kind, frozenset([checksum])), 256)
