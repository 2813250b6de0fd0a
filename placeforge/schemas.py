"""Schemas of the entity tables and the rules that their fields keep (V1)."""

from __future__ import annotations

from pyspark.sql import functions as F

EXIT = "struct<exit_code:string,lat:double,lng:double,source:string>"
PLATFORM = "struct<platform_code:string,towards_code:string,line_code:string>"
BUS_STOP = "struct<code:string,services:array<string>>"
ENRICHED_EXIT = f"struct<exit_code:string,platforms:array<{PLATFORM}>,accessibility:array<string>,bus_stops:array<{BUS_STOP}>,nearby_landmarks:array<string>>"
FINAL_EXIT = f"struct<exit_code:string,lat:double,lng:double,platforms:array<{PLATFORM}>,accessibility:array<string>,bus_stops:array<{BUS_STOP}>,nearby_landmarks:array<string>>"
ENTITY = f"station_id string, official_name string, display_name string, mrt_codes array<string>, lines array<string>, station_type string, exits array<{EXIT}>, fandom_url string, extraction_status string"
ENRICHMENT = f"station_id string, official_name string, extraction_result string, extraction_confidence string, exits array<{ENRICHED_EXIT}>, accessibility_notes array<string>, extraction_timestamp timestamp, source_url string, error_message string"
LEDGER = "entity_id string, status string, permanent boolean, attempts int, error string, reason string, ts timestamp"

#: Rules by name; each is SQL that must not be false or null.
ENTITY_RULES = {
    "station_id": r"station_id rlike '^[A-Z]{1,3}[0-9]+$'",
    "official_name": "official_name rlike '(MRT|LRT) STATION$'",
    "mrt_codes": "size(mrt_codes) >= 1",
    "lines": "size(lines) >= 1",
    "station_type": "station_type in ('mrt', 'lrt')",
    "exits": "size(exits) >= 1",
    "exit_bounds": "forall(exits, e -> e.lat between 1.0 and 2.0 and e.lng between 103.0 and 105.0)",
    "exit_source": "forall(exits, e -> e.source in ('onemap', 'datagov'))",
    "extraction_status": "extraction_status in ('pending', 'completed', 'failed')",
}
ENRICHMENT_RULES = {
    "extraction_result": "extraction_result in ('success', 'failed')",
    "extraction_confidence": "coalesce(extraction_confidence, 'low') in ('high', 'medium', 'low')",
    "line_code": r"forall(exits, e -> forall(coalesce(e.platforms, array()), p -> p.line_code rlike '^[A-Z]{2,5}$'))",
    "towards_code": r"forall(exits, e -> forall(coalesce(e.platforms, array()), p -> coalesce(p.towards_code, 'A') rlike '^[A-Z]{1,3}[0-9]*$'))",
    "bus_stop_code": r"forall(exits, e -> forall(coalesce(e.bus_stops, array()), b -> b.code rlike '^[0-9]{5}$'))",
}

#: The same by field, for rows that name the place of each violation.
ENTITY_FIELDS = {
    "station_id": lambda x: x.rlike("^[A-Z]{1,3}[0-9]+$"),
    "official_name": lambda x: x.rlike("(MRT|LRT) STATION$"),
    "mrt_codes": lambda x: F.size(x) >= 1,
    "station_type": lambda x: x.isin("mrt", "lrt"),
    "exits": lambda x: F.size(x) >= 1,
    "exits[].lat": lambda x: x.between(1.0, 2.0),
    "exits[].lng": lambda x: x.between(103.0, 105.0),
    "exits[].source": lambda x: x.isin("onemap", "datagov"),
}
ENRICHMENT_FIELDS = {
    "extraction_result": lambda x: x.isin("success", "failed"),
    "exits[].platforms[].line_code": lambda x: x.rlike("^[A-Z]{2,5}$"),
    "exits[].platforms[].towards_code": lambda x: F.coalesce(x, F.lit("A")).rlike("^[A-Z]{1,3}[0-9]*$"),
    "exits[].bus_stops[].code": lambda x: x.rlike("^[0-9]{5}$"),
}
