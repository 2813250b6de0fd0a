"""Scalar functions over Columns: names, exit labels, codes, URLs (F1-F23; F21 lies in names.py) and predicates (P1-P9). Nothing here leaves the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (SRC8): code prefixes, the lines they stand for, hubs and interchanges.
HEAVY = ("NS", "EW", "NE", "CC", "DT", "TE", "CG", "CR", "CE")
LIGHT = ("BP", "SW", "SE", "PW", "PE", "STC", "PTC")
LINES = {"NS": "NSL", "EW": "EWL", "NE": "NEL", "CC": "CCL", "CE": "CCL", "DT": "DTL", "TE": "TEL", "CG": "CGL", "CR": "CRL", "BP": "BPL", "A": "BPL", "SW": "SKL", "SE": "SKL", "PW": "PGL", "PE": "PGL", "JS": "JRL", "JW": "JRL", "JE": "JRL"}
SPECIAL_CODES = {"STC": "SKL", "PTC": "PGL"}
CODE_PREFIXES = ("NS", "EW", "NE", "CC", "CE", "DT", "TE", "CG", "BP", "SW", "SE", "PW", "PE", "STC", "PTC", "CR", "JS", "JW", "JE")
HUB_CODES = {"SENGKANG MRT STATION": ["STC"]}
INTERCHANGES = {"CHOA CHU KANG": "Choa_Chu_Kang", "BUKIT PANJANG": "Bukit_Panjang", "SENGKANG": "Sengkang", "PUNGGOL": "Punggol"}
SMALL_WORDS = ("a", "an", "the", "by", "in", "of", "on", "at", "to", "for", "with", "and", "or")
BOUNDS = (1.0, 2.0, 103.0, 105.0)


def strip(s: Column) -> Column:
    """All white space at both ends (trim takes blanks only)."""
    return F.regexp_replace(s, r"^\s+|\s+$", "")


def replaced(s: Column, *gone: str) -> Column:
    for g in gone:
        s = F.replace(s, F.lit(g), F.lit(""))
    return s


def exit_key(s: Column, retrim: bool = True) -> Column:
    """F1. Without `retrim` as the older form has it."""
    out = replaced(strip(F.upper(F.coalesce(s, F.lit("")))), "EXIT ", "EXIT")
    return strip(out) if retrim else out


def exit_label(s: Column) -> Column:
    """F2."""
    return F.concat(F.lit("Exit "), strip(F.regexp_replace(strip(s), "(?i)^EXIT", "")))


def exit_order(s: Column) -> Column:
    """O1: letters first, then numbers by value. A struct to sort by."""
    bare = strip(F.regexp_replace(strip(s), "(?i)^EXIT", ""))
    digits = bare.rlike("^[0-9]+$")
    return F.struct(F.when(digits, 1).otherwise(0).alias("k"), F.when(digits, bare.try_cast("bigint")).otherwise(F.lit(0).cast("bigint")).alias("n"), F.upper(bare).alias("v"))


def base_name(s: Column) -> Column:
    """F3."""
    return strip(replaced(F.upper(s), " MRT/LRT STATION", " MRT STATION", " LRT STATION", " STATION"))


def clean_building(s: Column) -> Column:
    """F4."""
    return strip(F.regexp_replace(F.regexp_replace(s, r"\(.*?\)", ""), r"\s+EXIT\s+[A-Z0-9]+", ""))


def official_name(s: Column) -> Column:
    """without the dot at its end; a name that has no suffix at its end loses those inside and gets one."""
    bare = F.regexp_replace(strip(s), r"\.$", "")
    known = bare.endswith(" MRT STATION") | bare.endswith(" LRT STATION")
    return F.when(known, bare).otherwise(F.concat(replaced(bare, " LRT STATION", " MRT STATION"), F.when(bare.contains("LRT"), " LRT STATION").otherwise(" MRT STATION")))


def display_name(s: Column) -> Column:
    """F6."""
    return F.when(s.contains(" MRT STATION"), replaced(s, " MRT STATION")).otherwise(replaced(s, " LRT STATION"))


def codes_loose(s: Column, prefixes: tuple[str, ...] = CODE_PREFIXES) -> Column:
    """bare prefixes match."""
    return F.regexp_extract_all(F.upper(s), F.lit(rf"\b((?:{'|'.join(prefixes)})\d*)\b"), F.lit(1))


def codes_strict(s: Column, prefixes: tuple[str, ...] = CODE_PREFIXES) -> Column:
    """F8: a number must follow."""
    return F.regexp_extract_all(F.upper(s), F.lit(rf"\b((?:{'|'.join(prefixes)})\d+)\b"), F.lit(1))


def station_type(s: Column) -> Column:
    """F9."""
    return F.when(s.contains("MRT/LRT STATION"), "mrt").when(s.contains("LRT STATION"), "lrt").otherwise("mrt")


def _lookup(table: dict[str, str], key: Column) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def code_line(code: Column) -> Column:
    """The line of a code: special codes first, else all its letters are the prefix; null if unknown."""
    return F.coalesce(_lookup(SPECIAL_CODES, code), _lookup(LINES, F.regexp_replace(code, "[^A-Za-z]", "")))


def detect_lines(codes: Column) -> Column:
    """codes without a line are left out."""
    return sorted_set(F.filter(F.transform(codes, code_line), lambda x: x.isNotNull()))


def detect_lines_strict(codes: Column) -> Column:
    """A code without a line is an error."""
    return sorted_set(F.transform(codes, lambda c: F.coalesce(code_line(c), F.raise_error(F.concat(F.lit("no line for code "), F.coalesce(c, F.lit("null")))).cast("string"))))


def sorted_set(values: Column) -> Column:
    """O2."""
    return F.array_sort(F.array_distinct(values))


def primary_code(codes: Column) -> Column:
    """F11."""
    return F.coalesce(F.try_element_at(codes, F.lit(1)), F.lit("UNKNOWN"))


def py_title(s: Column) -> Column:
    """every letter after a sign that is no letter is capital (ASCII)."""
    return F.array_join(F.transform(F.regexp_extract_all(s, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1)), lambda x: F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, F.lit(2), F.length(x))))), "")


def percent_quote(s: Column) -> Column:
    """F20."""
    return F.replace(F.replace(F.url_encode(s), F.lit("%2F"), F.lit("/")), F.lit("+"), F.lit("%20"))


def naive_url(name: Column, base: str) -> Column:
    """F13."""
    suffix = F.when(name.contains("LRT STATION") & ~name.contains("MRT/LRT"), "_LRT_Station").otherwise("_MRT_Station")
    return F.concat(F.lit(f"{base}/"), percent_quote(F.concat(F.replace(py_title(base_name(name)), F.lit(" "), F.lit("_")), suffix)))


def interchange_url(name: Column, base: str) -> Column:
    """F14."""
    own = base_name(name)
    return F.concat(F.lit(f"{base}/"), F.coalesce(_lookup(INTERCHANGES, own), F.replace(py_title(own), F.lit(" "), F.lit("_"))), F.lit("_MRT/LRT_Station"))


def url_candidates(name: Column, base: str) -> Column:
    """the spellings of a page's name, in the order in which they are tried."""
    own = F.regexp_replace(name, r"(?i) (?:MRT/LRT|MRT|LRT) STATION$", "")
    suffix = F.when(name.contains("MRT/LRT"), "MRT/LRT_Station").when(name.contains("LRT"), "LRT_Station").otherwise("MRT_Station")
    words = F.transform(F.filter(F.split(own, r"\s+"), lambda w: w != ""), lambda w: F.when(F.lower(w).isin(*SMALL_WORDS), F.lower(w)).otherwise(py_title(w)))
    line = lambda s: F.replace(s, F.lit(" "), F.lit("_"))
    special = F.when(F.lower(own) == "macpherson", "Macpherson").when(F.lower(own) == "one-north", "One-north")
    forms = F.array_compact(F.array(line(py_title(own)), F.array_join(words, "_"), line(F.lower(own)), line(own), special))
    return F.array_distinct(F.transform(forms, lambda x: F.concat(F.lit(f"{base}/"), x, F.lit("_"), suffix)))


def cache_key(s: Column) -> Column:
    """F16."""
    return F.replace(F.lower(s), F.lit(" "), F.lit("_"))


def reduction_percent(before: Column, after: Column) -> Column:
    """F17."""
    return F.when(before > 0, F.round((before - after) * 100.0 / before, 1)).otherwise(0.0)


def reduction_ratio(before: Column, after: Column) -> Column:
    """F17."""
    return F.round(before / F.greatest(after, F.lit(1)), 1)


def truncate(s: Column, limit: int = 150_000) -> Column:
    """F18."""
    return F.substring(s, 1, limit)


def data_version(ts: Column, compact: bool = False) -> Column:
    """F22."""
    return F.date_format(ts, "yyyyMMdd" if compact else "yyyy-MM-dd")


def source_name(s: Column) -> Column:
    """F23."""
    return F.replace(F.upper(s), F.lit(" LRT STATION"), F.lit(" MRT STATION"))


def in_bounds(lat: Column, lng: Column, bounds: tuple[float, float, float, float] = BOUNDS) -> Column:
    """Both ends count; null passes."""
    return F.coalesce(lat.between(bounds[0], bounds[1]) & lng.between(bounds[2], bounds[3]), F.lit(True))


def is_interchange(codes: Column) -> Column:
    """P2."""
    return F.exists(codes, lambda c: c.rlike(f"^({'|'.join(HEAVY)})")) & F.exists(codes, lambda c: c.rlike(f"^({'|'.join(LIGHT)})"))


def has_entity_suffix(s: Column, suffix: str = "MRT STATION") -> Column:
    """P3."""
    return s.contains(suffix) & ~s.contains("EXIT")


def nonempty(values: Column) -> Column:
    """An empty array counts as absent."""
    return F.when(F.size(values) > 0, values)


def missing(cols: list[str]) -> Column:
    """P5: names of columns that are null or empty, as a string or as an array."""
    empty = lambda c: F.when(F.typeof(c).startswith("array"), F.col(c).cast("string") == "[]").otherwise(F.col(c).cast("string") == "")
    return F.array_compact(F.array(*[F.when(F.col(c).isNull() | empty(c), F.lit(c)) for c in cols]))


def valid_codes(codes: Column) -> Column:
    """At least one code, none with an unknown prefix."""
    return (F.size(codes) > 0) & F.forall(codes, lambda c: code_line(c).isNotNull())


def is_failed_extraction(result: Column, exits: Column) -> Column:
    """P8."""
    return F.coalesce(result != "success", F.lit(True)) | (F.coalesce(F.size(exits), F.lit(0)) < 1)


def needs_url(url: Column) -> Column:
    """True where the URL is missing."""
    return url.isNull() | (url == "")
