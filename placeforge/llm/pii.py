"""Personal data with DataFrame functions only: base patterns, and terms that disclose the values found, by corpus co-occurrence."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.llm.common import bound, cut, marks, running

KINDS = ("email", "ip", "card", "phone", "term")
# The base patterns. (?:\G|(?<!..)) only keeps the search from starting anew inside a run that has failed; a possessive end
# matches the same and doesn't recurse, however long the run.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text has if it has the kind; cheap, and only there to skip the search.
NEEDS = {"email": "@", "ip": r"[0-9]\.[0-9]", "card": r"[0-9](?:[\x20-]?[0-9]){12}", "phone": r"\+[0-9]"}
SPAN = "array<struct<kind:int,start:int,end:int,value:string>>"
FOUND = "array<struct<kind:int,start:int,end:int,value:string,left:string,right:string>>"
#: Terms are words of three letters or more.
LETTERS = r"\p{L}{3,}"


@dataclass(frozen=True)
class Settings:
    """window: code points on each side of a value, up to the next value of its kind, that are its context. support: different texts, with
    different contexts, in which a term must stand beside a value. disclosure: share of the value's information that a term must give;
    from `removal` on it is removed, below generalised."""

    window: int = 200
    support: int = 3
    disclosure: float = 0.6
    removal: float = 0.9


def _places(text: Column, pattern: str, window: int = 0) -> Column:
    """Array of (start, end, value, left, right), from 0, end exclusive; left and right: up to `window` code points beside the match.

    What splitting leaves and what matches, in turns, make up the text.
    """
    rest = F.split(text, F.lit(pattern), -1)
    turns = F.arrays_zip(rest.alias("rest"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("found"), F.slice(rest, 2, F.size(rest)).alias("next"))
    begin = lambda at, x: at + F.length(x["rest"])
    end = lambda at, x: begin(at, x) + F.coalesce(F.length(x["found"]), F.lit(0))

    def match(at: Column, x: Column) -> Column:
        left = F.when(F.length(x["rest"]) > window, F.regexp_replace(F.right(x["rest"], F.lit(window)), r"^\S*", "")).otherwise(x["rest"])
        right = F.when(F.length(x["next"]) > window, F.regexp_replace(F.left(x["next"], F.lit(window)), r"\S*$", "")).otherwise(x["next"])
        sides = (left, right) if window else (F.lit(""), F.lit(""))
        return F.struct(begin(at, x).alias("start"), end(at, x).alias("end"), x["found"].alias("value"), sides[0].alias("left"), sides[1].alias("right"))

    return F.filter(running(turns, end, match, "array<struct<start:int,end:int,value:string,left:string,right:string>>"), lambda x: x["value"].isNotNull())


def _luhn(digits: Column) -> Column:
    def value(i: Column) -> Column:
        d = F.substring(digits, F.length(digits) - i + 1, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
        return F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda a, i: a + value(i)) % 10 == 0


def _holds(kind: str, value: Column) -> Column:
    digits = F.regexp_replace(value, "[^0-9]", "")
    if kind == "ip":
        return F.forall(F.split(value, r"\."), lambda p: F.when(F.length(F.regexp_replace(p, "^0+", "")) > 3, False).otherwise(F.regexp_replace(p, "^0+(?=.)", "").cast("int") <= 255))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _found(text: Column, window: int = 0) -> Column:
    """Array of (kind, start, end, value, left, right) of the base patterns, by kind, then start; kind is a place in KINDS."""
    each = []
    for k, kind in enumerate(KINDS[:4]):
        held = F.filter(_places(text, PATTERNS[kind], window), lambda x: _holds(kind, x["value"]))
        held = F.transform(held, lambda x: F.struct(F.lit(k).alias("kind"), *[x[c].alias(c) for c in ("start", "end", "value", "left", "right")]))
        each.append(F.when(text.rlike(NEEDS[kind]), held).otherwise(F.array().cast(FOUND)))
    return F.flatten(F.array(*each))


def _spans(found: Column) -> Column:
    return F.transform(found, lambda x: F.struct(*[x[c].alias(c) for c in ("kind", "start", "end", "value")]))


def _own(docs: DataFrame, id_col: str, text_col: str, *others: Column) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(*others, F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(text).alias("h"), text.alias("text"))


def _rows(docs: DataFrame, s: Settings, id_col: str, text_col: str) -> DataFrame:
    """doc_id, h, base spans and, for each, its entity (kind and value) and context, for every row."""
    rows = _own(docs, id_col, text_col).select("doc_id", "h", _found(F.col("text"), s.window).alias("found"))
    entity = lambda x: F.concat_ws(":", x["kind"], F.lower(x["value"]))
    contexts = F.transform("found", lambda x: F.struct(entity(x).alias("entity"), F.lower(F.concat_ws(" ", x["left"], x["right"])).alias("words")))
    return cut(rows.select("doc_id", "h", _spans(F.col("found")).alias("base"), contexts.alias("contexts")), "spans")


def disclosing_terms(rows: DataFrame, docs: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text") -> DataFrame | None:
    """(doc_id, h, terms): spans of terms, anywhere in a text that holds a value which they disclose; None if there are none.

    The share that decides: pointwise mutual information of term and value by the information of the value, log2(c N / (d v)) / log2(N / v), with N
    different texts, v of them with the value, d with the term, c with the term in the value's context. A value that all texts hold gives
    no information and is disclosed by nothing.
    """
    context = rows.where(F.size("contexts") > 0).select("doc_id", "h", F.explode("contexts").alias("c")).select("doc_id", "h", "c.*")
    alone = cut(context.groupBy("entity", "h").agg(F.lit(1)).groupBy("entity").agg(F.count("*").alias("v")).where(F.col("v") >= s.support), "values")
    if alone.isEmpty():
        return None
    n = float(rows.groupBy("h").agg(F.lit(1)).count())
    often = marks(alone, "entity")
    words = context.where(often(F.col("entity"))).select("entity", "h", F.xxhash64("words").alias("context"), F.explode(F.array_distinct(F.regexp_extract_all("words", F.lit(LETTERS), F.lit(0)))).alias("term"))
    words = cut(words.groupBy("entity", "term", "h").agg(F.min("context").alias("context")), "words")
    together = words.groupBy("entity", "term").agg(F.count("*").alias("c"), F.count_distinct("context").alias("contexts")).where((F.col("c") >= s.support) & (F.col("contexts") >= s.support))
    together = cut(together.join(alone, "entity").where(F.col("v") < n).select("entity", "term", "c", "v"), "together")
    # the texts that hold a term in some context are no more than all that hold it: too many of them rule a pair out before the corpus is counted
    asked = marks(together, "term")
    beside = context.select("h", F.explode(F.array_distinct(F.regexp_extract_all("words", F.lit(LETTERS), F.lit(0)))).alias("term")).where(asked(F.col("term")))
    least = beside.groupBy("term", "h").agg(F.lit(1)).groupBy("term").agg(F.count("*").alias("low"))
    most = F.col("c") * F.pow(F.lit(n) / F.col("v"), 1 - s.disclosure)
    together = cut(together.join(least, "term").where(F.col("low") <= most).select("entity", "term", "c", "v"), "together")
    if together.isEmpty():
        return None
    wanted = marks(together, "term")
    spoken = _own(docs, id_col, text_col).select("h", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("text"), F.lit(LETTERS), F.lit(0)))).alias("term")).where(wanted(F.col("term")))
    texts = spoken.groupBy("term", "h").agg(F.lit(1)).groupBy("term").agg(F.count("*").alias("d"))
    share = F.log2(F.col("c") * n / (F.col("d") * F.col("v"))) / F.log2(F.lit(n) / F.col("v"))
    told = cut(together.join(texts, "term").select("entity", "term", share.alias("share")).where(F.col("share") >= s.disclosure), "told")
    if told.isEmpty():
        return None
    held = context.where(marks(told, "entity")(F.col("entity"))).select("doc_id", "h", "entity").distinct().join(told, "entity")
    given = cut(held.groupBy("doc_id", "h", "term").agg(F.max("share").alias("share")), "given")
    said = _own(docs, id_col, text_col).where(marks(given, "h")(F.col("h"))).select("doc_id", "h", F.explode(_places(F.col("text"), LETTERS)).alias("w"))
    said = said.select("doc_id", "h", F.lower("w.value").alias("term"), "w.start", "w.end").where(marks(given, "term")(F.col("term")))
    same = said["doc_id"].eqNullSafe(given["doc_id"]) & (said["h"] == given["h"]) & (said["term"] == given["term"])
    one = F.struct(F.lit(4).alias("kind"), "start", "end", F.when(F.col("share") >= s.removal, "").otherwise("[TERM]").alias("value"))
    spans = said.join(given, same).select(said["doc_id"], said["h"], one.alias("span"))
    return cut(spans.groupBy("doc_id", "h").agg(F.array_sort(F.collect_set("span")).cast(SPAN).alias("terms")), "terms")


def _joined(spans: Column) -> Column:
    name = lambda k: F.element_at(F.array(*map(F.lit, KINDS)), k + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", name(x["kind"]), x["start"], x["end"])), ",")


def _add_terms(rows: DataFrame, terms: DataFrame | None) -> DataFrame:
    none = F.array().cast(SPAN)
    if terms is None:
        return rows.withColumn("terms", none)
    same = rows["doc_id"].eqNullSafe(terms["doc_id"]) & (rows["h"] == terms["h"])
    return rows.join(terms, same, "left").select(rows["*"], F.coalesce(terms["terms"], none).alias("terms"))


def find(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term for every row.

    A null text counts as empty: no span, the hash of the empty string. Repeated rows give repeated results, an empty table no row.
    Rows are told apart by doc_id and a hash of the text, so a null or repeated doc_id does no harm.
    """
    rows = _rows(docs, s, id_col, text_col)
    every = _add_terms(rows.select("doc_id", "h", "base"), disclosing_terms(rows, docs, s, id_col, text_col))
    number = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return every.select("doc_id", *[number(k).alias(f"n_{KINDS[k]}") for k in range(4)], F.sha2(_joined(F.col("base")), 256).alias("base_sha256"), _joined(F.concat("base", "terms")).alias("spans"), F.size("terms").cast("long").alias("n_term"))


#: Code points of a text that are cut off at once.
CHUNK = 1024


def _rewritten(text: Column, spans: Column) -> Column:
    """The text with each span (of overlapping ones the first, and what reaches beyond it) replaced by its value."""
    order = F.array_sort(F.transform(spans, lambda x: F.struct(x["start"].alias("start"), (-x["end"]).alias("back"), x["value"].alias("value"))))
    last = F.struct(F.length(text).alias("start"), F.lit(0).alias("back"), F.lit("").alias("value"))
    items = F.concat(order, F.array(last))

    def piece(chunks: Column, begin: Column, end: Column) -> Column:
        first = (begin / CHUNK).cast("int")
        own = F.array_join(F.slice(chunks, first + 1, ((end - 1) / CHUNK).cast("int") - first + 1), "")
        return F.when(end > begin, F.substring(own, begin - first * CHUNK + 1, end - begin)).otherwise("")

    def joined(chunks: Column) -> Column:
        step = lambda at, x: F.greatest(at, -x["back"])
        emit = lambda at, x: F.when(x["start"] >= at, F.concat(piece(chunks, at, x["start"]), x["value"])).otherwise("")
        return F.array_join(running(items, step, emit, "array<string>"), "")

    return bound(F.regexp_extract_all(text, F.lit(f"(?s).{{1,{CHUNK}}}"), F.lit(0)), joined)


def sanitise(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`docs` with its columns, the text without personal data: values become their kind ("[EMAIL]"), disclosing terms are generalised to
    "[TERM]" or removed.

    Texts without a span, and nulls, stay as they are. Repeated rows stay, each with its text; an empty table gives no row. Rows are told apart by
    doc_id and a hash of the text. Texts without a disclosing term are rewritten where they lie.
    """
    rows = _rows(docs, s, id_col, text_col)
    terms = disclosing_terms(rows, docs, s, id_col, text_col)
    own = _own(docs, id_col, text_col, F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    if terms is None:
        own = _add_terms(own, None)
    else:
        held = marks(terms, "h")(F.col("h"))
        own = _add_terms(own.where(~held), None).unionByName(_add_terms(own.where(held), terms))
    named = F.transform(_spans(_found(F.col("text"))), lambda x: F.struct(x["kind"].alias("kind"), x["start"].alias("start"), x["end"].alias("end"), F.element_at(F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS]), x["kind"] + 1).alias("value")))
    own = own.withColumn("spans", F.concat(named, "terms"))
    clean = F.when(F.size("spans") > 0, _rewritten(F.col("text"), F.col("spans"))).otherwise(F.col(f"row.`{text_col}`"))
    return own.withColumn("clean", clean).select(*[F.col("clean").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
