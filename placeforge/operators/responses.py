"""Structured responses: cleaning, parsing, checking, typed results."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.functions import scalars as S
from placeforge.schemas import ENRICHED_EXIT

TEMPLATE = "Extract exits, platforms and bus stops of {name} as JSON.\n{content}"


def clean_response(s: Column) -> Column:
    """L1."""
    return S.strip(F.regexp_replace(F.regexp_replace(s, r"```json\s*", ""), r"```\s*", ""))


def parse_response(s: Column) -> Column:
    """L2: a VARIANT, null if it is no JSON."""
    return F.try_parse_json(clean_response(s))


def _kind(v: Column, path: str) -> Column:
    return F.schema_of_variant(F.try_variant_get(v, path, "variant"))


def _list_or_absent(v: Column, path: str) -> Column:
    k = _kind(v, path)
    return k.isNull() | k.startswith("ARRAY") | (k == "VOID")


def response_is_valid(v: Column) -> Column:
    """L3: an object whose `exits` is a list of objects with exit_code; lists where lists belong; bus stops with a code."""
    exits = F.try_variant_get(v, "$.exits", "array<variant>")

    def exit_ok(e: Column) -> Column:
        stops = F.try_variant_get(e, "$.bus_stops", "array<variant>")
        lists = _list_or_absent(e, "$.platforms") & _list_or_absent(e, "$.accessibility") & _list_or_absent(e, "$.nearby_landmarks") & _list_or_absent(e, "$.bus_stops")
        return F.coalesce(F.schema_of_variant(e).startswith("OBJECT") & F.try_variant_get(e, "$.exit_code", "string").isNotNull() & lists & F.coalesce(F.forall(stops, lambda b: F.try_variant_get(b, "$.code", "string").isNotNull()), F.lit(True)), F.lit(False))

    listed = F.coalesce(_kind(v, "$.exits").startswith("ARRAY"), F.lit(False))
    return F.when(v.isNull(), False).otherwise(listed & F.coalesce(F.forall(exits, exit_ok), F.lit(True)))


def to_enrichment(v: Column) -> Column:
    """L4: the typed result with its defaults."""
    get = lambda path, kind: F.try_variant_get(v, path, kind)
    return F.struct(
        F.coalesce(get("$.extraction_confidence", "string"), F.lit("medium")).alias("extraction_confidence"),
        F.coalesce(get("$.exits", f"array<{ENRICHED_EXIT}>"), F.array().cast(f"array<{ENRICHED_EXIT}>")).alias("exits"),
        F.coalesce(get("$.accessibility_notes", "array<string>"), F.array().cast("array<string>")).alias("accessibility_notes"),
    )


def empty_content_result() -> Column:
    """L5."""
    return F.struct(F.lit("low").alias("extraction_confidence"), F.array().cast(f"array<{ENRICHED_EXIT}>").alias("exits"), F.array(F.lit("No relevant content found")).alias("accessibility_notes"))


def result_issues(v: Column) -> Column:
    """(issues, warnings, exit_count)."""
    exits = F.try_variant_get(v, "$.exits", "array<variant>")
    n = F.coalesce(F.size(exits), F.lit(0))

    def of(e: Column, i: Column) -> Column:
        at = F.concat(F.lit("exit_"), i.cast("string"))
        stops = _kind(e, "$.bus_stops")
        listed = F.try_variant_get(e, "$.bus_stops", "array<variant>")
        return F.array_compact(
            F.array(
                F.when(~F.schema_of_variant(e).startswith("OBJECT"), F.concat(at, F.lit(":not_object"))),
                F.when(F.schema_of_variant(e).startswith("OBJECT") & F.try_variant_get(e, "$.exit_code", "string").isNull(), F.concat(at, F.lit(":no_exit_code"))),
                F.when(stops.isNotNull() & ~stops.startswith("ARRAY"), F.concat(at, F.lit(":bus_stops_not_list"))),
                F.when(F.exists(listed, lambda b: F.try_variant_get(b, "$.code", "string").isNull()), F.concat(at, F.lit(":bus_stop_no_code"))),
            )
        )

    issues = F.when(v.isNull(), F.array(F.lit("no_result"))).otherwise(F.concat(F.when(n == 0, F.array(F.lit("no_exits"))).otherwise(F.array().cast("array<string>")), F.coalesce(F.flatten(F.transform(exits, of)), F.array().cast("array<string>"))))
    warnings = F.when(F.try_variant_get(v, "$.extraction_confidence", "string") == "low", F.array(F.lit("low_confidence"))).otherwise(F.array().cast("array<string>"))
    return F.struct(issues.alias("issues"), warnings.alias("warnings"), n.cast("long").alias("exit_count"))


def build_requests(df: DataFrame, key: str, name: str, content: str, limit: int = 150_000, template: str = TEMPLATE) -> DataFrame:
    """L7, F18."""
    before, after = template.split("{content}")
    head, tail = before.split("{name}")
    return df.select(key, F.concat(F.lit(head), F.col(name), F.lit(tail), S.truncate(F.col(content), limit), F.lit(after)).alias("prompt"))


def extract_with(requests: DataFrame, fn: Callable[[pd.Series], list[str]], key: str) -> DataFrame:
    """Fn maps a batch of prompts to responses. The rows of a batch that fails are tried one by one; a row that fails gives its error, of
    which 500 characters are kept, and the others go on."""
    kind = dict(requests.dtypes)[key]

    def one(prompt: pd.Series) -> tuple[str | None, str | None]:
        try:
            return list(fn(prompt))[0], None
        except Exception as e:  # user code
            return None, str(e)[:500]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for x in batches:
            try:
                response = list(fn(x["prompt"]))
                if len(response) != len(x):
                    raise ValueError(f"{len(response)} responses for {len(x)} prompts")
                told = [(r, None) for r in response]
            except Exception:  # user code
                told = [one(x["prompt"].iloc[k : k + 1]) for k in range(len(x))]
            yield pd.DataFrame({key: x[key], "response": [r for r, _ in told], "error": [e for _, e in told]})

    return requests.select(key, "prompt").mapInPandas(run, f"{key} {kind}, response string, error string")


def table_parser(prompts: pd.Series) -> list[str]:
    """The default extractor: exit names that a prompt holds, as a response."""
    import json
    import re

    return [json.dumps({"exits": [{"exit_code": c} for c in dict.fromkeys(re.findall(r"Exit ([A-Z0-9]{1,2})\b", p))], "extraction_confidence": "medium"}) for p in prompts]
