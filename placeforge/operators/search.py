"""Search of page titles by weighted words: the step of the URL chain behind the candidates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placeforge.sources.io import cut


def title_words(text: Column) -> Column:
    """Distinct lower-case runs of letters and digits, sorted."""
    return F.array_sort(F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))))


def page_title(url: Column, base: str) -> Column:
    """What a page's address says behind the base, decoded, with blanks for underscores."""
    return F.replace(F.try_url_decode(F.replace(F.substring(url, len(base) + 2, 100_000), F.lit("+"), F.lit("%2B"))), F.lit("_"), F.lit(" "))


def search_titles(wanted: DataFrame, pages: DataFrame, key: str, name: str, base: str, least_share: float = 0.5, long: int = 40) -> DataFrame:
    """(key, search_url, search_score): for each name the page whose title shares the most weight of words with it.

    A word that n of N titles hold weighs floor(1000 ln(1 + N / n)), one that none holds as if one did. A hit has at least `least_share`
    of the name's weight; of equal hits the one with fewer words, then the least address. Exact without asking common words: a hit must
    hold one of the rarest words, as many as it takes until all others weigh less than that share, so only their postings are joined. Where
    the two rarest are in every hit (all other words together weigh less than that share without either), the postings of both at once are
    joined; titles of more than `long` words, whose pairs of words would be many, stay with single words.
    Equal sets of words are searched once; names without a word, names whose words that titles hold weigh less than that share, and null
    addresses, have no hit and join nothing.
    """
    titles = pages.where(F.col("url").startswith(f"{base}/")).select("url").distinct().withColumn("words", title_words(page_title(F.col("url"), base))).where(F.size("words") > 0)
    titles = cut(titles, "titles")
    postings = titles.select("url", "words", F.explode("words").alias("word"))
    often = postings.groupBy("word").agg(F.count("*").alias("n"))
    total = titles.agg(F.count("*").alias("total"))
    asked = wanted.select(key, title_words(F.col(name)).alias("asked")).where(F.size("asked") > 0)
    sets = asked.select("asked").distinct()
    weight = F.floor(F.lit(1000) * F.log(1 + F.col("total") / F.coalesce("n", F.lit(1)))).cast("long")
    each = sets.select("asked", F.explode("asked").alias("word")).join(often, "word", "left").crossJoin(F.broadcast(total))  # one row
    weighed = each.groupBy("asked").agg(F.sort_array(F.collect_list(F.struct(weight.alias("w"), "word", F.col("n").isNotNull().alias("known"))), asc=False).alias("ws"))
    weighed = weighed.withColumn("need", F.lit(least_share) * F.aggregate("ws", F.lit(0).cast("long"), lambda s, x: s + x["w"]))
    known = F.filter("ws", lambda x: x["known"])
    # words by falling weight; one is asked while it and those behind it could still make a hit
    rest = F.transform(known, lambda x, i: F.struct(x["word"].alias("word"), F.aggregate(F.slice(known, i + 1, F.greatest(F.size(known), F.lit(1))), F.lit(0).cast("long"), lambda s, y: s + y["w"]).alias("left")))
    lacking = lambda k: F.aggregate(known, F.lit(0).cast("long"), lambda s, x: s + x["w"]) - F.get(known, F.lit(k))["w"]
    both = (F.size(known) > 1) & F.coalesce((lacking(0) < F.col("need")) & (lacking(1) < F.col("need")), F.lit(False))
    probes = weighed.withColumn("both", both).withColumn("first", F.get(known, F.lit(0))["word"]).withColumn("second", F.get(known, F.lit(1))["word"]).withColumn("probe", F.filter(rest, lambda x: x["left"] >= F.col("need")).getField("word"))
    # a name whose known words all together weigh too little has no hit, and would else meet every title that holds two common words
    probes = cut(probes.where(F.size("probe") > 0), "probes")
    alone = probes.where("not both").select("asked", "ws", "need", F.explode("probe").alias("word")).hint("merge").join(postings, "word")
    beyond = probes.where("both").select("asked", "ws", "need", F.col("first").alias("word")).hint("merge").join(postings.where(F.size("words") > long), "word")
    two = F.flatten(F.transform("words", lambda x, i: F.transform(F.slice("words", i + 2, F.size("words")), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    twos = titles.where(F.size("words") <= long).select("url", "words", F.explode(two).alias("p")).select("url", "words", "p.*")
    together = probes.where("both").select("asked", "ws", "need", F.least("first", "second").alias("a"), F.greatest("first", "second").alias("b")).hint("merge").join(twos, ["a", "b"])
    pairs = alone.drop("word").unionByName(beyond.drop("word")).unionByName(together.drop("a", "b"))
    score = F.aggregate(F.filter("ws", lambda x: F.array_contains(F.col("words"), x["word"])), F.lit(0).cast("long"), lambda s, x: s + x["w"])
    # the greatest by score, then by fewer words; the least address of those, by an aggregate over the two
    hits = pairs.select("asked", "url", score.alias("score"), F.size("words").alias("size"), "need").where("score >= need").groupBy("asked").agg(F.min_by(F.struct("url", "score"), F.struct(-F.col("score"), "size", "url")).alias("hit"))
    return asked.hint("merge").join(hits, "asked").select(key, F.col("hit.url").alias("search_url"), F.col("hit.score").alias("search_score"))
