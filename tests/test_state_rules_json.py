"""Buckets of the ledger, recovery, rules of nested fields and canonical JSON on small tables."""

import hashlib
import json
import os

import pytest
from pyspark.sql import functions as F

from placeforge.functions.canonical import canonical_json, check_sealed, sealed
from placeforge.operators import ledger as L
from placeforge.operators import rules as V
from placeforge.sources import state


def attempts(spark, rows):
    return spark.createDataFrame(rows, "entity_id long, status string, attempts int, ts long")


def files(base, version):
    return {x for x in os.listdir(f"{base}/data/version={version}") if x.startswith("bucket=")}


def test_only_touched_buckets_are_written(spark, tmp_path):
    base = str(tmp_path / "ledger")
    first = attempts(spark, [(k, "success", 1, 1) for k in range(1000)] + [(None, "failed", 1, 1)])
    assert len(state.upsert_buckets(first, base, 0, buckets=50)) == 50
    few = attempts(spark, [(k, "failed", 1, 2) for k in range(0, 1000, 100)])
    touched = state.upsert_buckets(few, base, 1, buckets=50)
    assert len(touched) <= 10 and files(base, 1) == {f"bucket={b}" for b in touched}
    want = L.apply_outcomes(first.where("entity_id is not null"), few)
    got = state.read_buckets(spark, base)
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    state.upsert_buckets(few, base, 1, buckets=50)  # replayed
    again = state.read_buckets(spark, base)
    assert sorted(map(tuple, again.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))
    assert state.read_buckets(spark, base, below=1).where("status = 'failed'").count() == 0 and state.read_buckets(spark, base, below=0) is None


def test_what_no_map_needs_is_removed(spark, tmp_path):
    base = str(tmp_path / "ledger")
    state.upsert_buckets(attempts(spark, [(k, "success", 1, 0) for k in range(40)]), base, 0, buckets=4, keep=2)
    for v in range(1, 7):
        state.upsert_buckets(attempts(spark, [(1, "failed", 1, v)]), base, v, buckets=4, keep=2)
    kept = state.read_buckets(spark, base)
    assert kept.count() == 40 and kept.where("entity_id = 1").first()["attempts"] == 6
    versions = sorted(int(x.split("=")[1]) for x in os.listdir(f"{base}/map") if "=" in x)
    assert versions[0] >= 4 and not any(os.path.isdir(f"{base}/data/version={v}") for v in (1, 2, 3)) and len(files(base, 0)) == 3
    assert state.read_buckets(spark, base, below=6).where("entity_id = 1").first()["attempts"] == 5


def test_recovery_passes_over_what_cannot_be_read(spark, tmp_path):
    own, res = spark.createDataFrame([(1,), (None,)], "entity_id long"), spark.createDataFrame([(1, "failed"), (1, "success"), (2, "skipped")], "entity_id long, status string")
    state.write_saved(own, res, str(tmp_path / "good"))
    os.makedirs(tmp_path / "bad/processed")
    (tmp_path / "bad/processed/part-0.parquet").write_text("no parquet")
    good, bad, none = (state.read_saved(spark, str(tmp_path / x)) for x in ("good", "bad", "none"))
    assert bad == (None, None) == none
    name, df = state.recover(good, none, none)
    assert name == "main" and [tuple(r) for r in df.collect()] == [(1, "success")]
    name, df = state.recover(bad, none, state.Saved(None, res))
    assert name == "final" and sorted(map(tuple, df.collect())) == [(1, "success"), (2, "skipped")]
    assert state.recover(bad, none, none) is None


def test_rules_name_places(spark):
    schema = "id int, e array<struct<c:string,s:array<struct<n:int>>>>, p struct<q:int>"
    df = spark.createDataFrame([(1, [("a", [(1,), (9,)]), ("B", None), (None, [])], (1,)), (2, None, None), (3, [], (None,))], schema)
    rules = {"e": lambda x: F.size(x) > 0, "e[].c": lambda x: x.rlike("^[a-z]$"), "e[].s[].n": lambda x: x < 5, "p.q": lambda x: x == 1}
    got = sorted((r.id, r.path, r.value or "") for r in V.violations(df, "id", rules).collect())
    assert got == [(1, "e[0].s[1].n", "9"), (1, "e[1].c", "B"), (1, "e[2].c", ""), (2, "e", ""), (3, "e", "[]"), (3, "p.q", "")]
    assert {(r.rule, r.n) for r in V.violation_counts(V.violations(df, "id", rules)).collect()} == {("e[].s[].n", 1), ("e[].c", 2), ("e", 2), ("p.q", 1)}
    for wrong in ("x", "e.c", "e[].d", "p[]"):
        with pytest.raises(ValueError):
            V.compiled(df.schema, {wrong: lambda x: x})


def plain(v):
    if hasattr(v, "asDict"):
        return {k: plain(x) for k, x in v.asDict().items()}
    return [plain(x) for x in v] if isinstance(v, list) else {k: plain(x) for k, x in v.items()} if isinstance(v, dict) else v


TEXTS = ["", "plain", 'q"b\\', "é😀 ", "\n\t\r\b\f\x00\x1f\x7f", "a/b <&>", None]
REALS = [0.0, -0.0, 1.0, 1.5, 123456789.25, 1e7, 9999999.0, 1e15, 1e16, 1.2345678901234567e22, 1e-3, 1e-4, 1.25e-4, 1e-5, 1.5e-7, 0.1, -2.5e-300, 1e300, None]


def test_canonical_json(spark):
    schema = "id int, z string, a struct<y:double,b:array<struct<d:long,c:boolean>>>, m map<string,double>"
    rows = [(k, t, (r, [(k, True), None] if k % 2 else None), {"b": r, "a": 1.0} if k % 3 else None) for k, (t, r) in enumerate([(t, r) for t in TEXTS for r in REALS])]
    df = spark.createDataFrame(rows, schema)
    for r in df.select("*", canonical_json(F.struct(*df.columns), df.schema).alias("j")).collect():
        own = plain(r)
        j = own.pop("j")
        assert j == json.dumps(own, separators=(",", ":"), sort_keys=True)


def test_sealed_documents(spark):
    schema = "d struct<stations:array<struct<n:string>>,metadata:struct<v:string,file_size_bytes:long,checksum_sha256:string>>"
    df = spark.createDataFrame([(([("é",)], ("1", None, None)),)], schema)
    kind = df.schema["d"].dataType
    size, checksum = df.select(*sealed(F.col("d"), kind)).first()
    want = {"stations": [{"n": "é"}], "metadata": {"v": "1", "file_size_bytes": 0}}
    dump = lambda x: json.dumps(x, separators=(",", ":"), sort_keys=True).encode()
    assert size == len(dump(want))
    want["metadata"]["file_size_bytes"] = size
    assert checksum == hashlib.sha256(dump(want)).hexdigest()
    full = spark.createDataFrame([(([("é",)], ("1", size, checksum)),), (([("e",)], ("1", size, checksum)),), (([], ("1", 1, None)),)], schema)
    assert [r[0] for r in full.select(check_sealed(F.col("d"), kind)).collect()] == [True, False, None]
