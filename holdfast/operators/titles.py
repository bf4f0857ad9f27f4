"""Titles that differ by a few edits, found through an index of their rarest trigrams.

An edit changes at most three trigrams. So two titles within k edits share one of the first
3 k + 1 trigrams of each, in any order that is the same for both: here the rarest first. Only
these are joined, and the pairs that meet are compared by edit distance; there is no
comparison of all titles with all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.joins import lookup

MOST_EDITS = 2


def plain_title(title: Column) -> Column:
    """Lower case, without white space around it, single spaces inside."""
    return F.trim(F.regexp_replace(F.lower(title), r"\s+", " "))


def allowed_edits(title: Column) -> Column:
    """No edit up to 4 characters, one up to 9, two beyond."""
    size = F.length(title)
    return F.when(size < 5, 0).when(size < 10, 1).otherwise(MOST_EDITS)


def _grams(title: Column) -> Column:
    """Trigrams of the padded title; the n-th of equal ones carries n, so each is its own."""
    padded = F.concat(F.lit("\x01\x01"), title, F.lit("\x02\x02"))
    grams = F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, 3))
    return F.transform(
        grams, lambda g, i: F.concat(g, F.size(F.filter(F.slice(grams, F.lit(1), i), lambda x: x == g)).cast("string"))
    )


def _rarest(titles: DataFrame, counts: DataFrame, name: str, edits: Column) -> DataFrame:
    """``name`` and each of the first 3 * edits + 1 trigrams of every distinct title."""
    grams = titles.select(name, F.explode(_grams(F.col(name))).alias("gram"))
    counted = lookup(grams, counts, ["gram"])
    order = F.array_sort(F.collect_list(F.struct(F.coalesce("titles", F.lit(0)).alias("titles"), "gram")))
    listed = counted.groupBy(name).agg(order.alias("grams"))  # as many as a title has characters
    return listed.select(name, F.explode(F.slice("grams.gram", F.lit(1), 3 * edits + 1)).alias("gram"))


def closest_posters(wanted: DataFrame, posters: DataFrame) -> DataFrame:
    """``title`` and the ``poster_path`` and ``edits`` of the closest poster, for each distinct title that has one.

    Titles are compared as :func:`plain_title` gives them, within :func:`allowed_edits` of the
    wanted one. The fewest edits win, then a movie before a series, then the smaller title and path.
    Null and empty titles have no poster.
    """
    asked = wanted.select("title", plain_title(F.col("title")).alias("plain")).filter("plain <> ''").distinct()
    kind = F.when(F.col("media_type") == "movie", 0).when(F.col("media_type") == "tv", 1)
    known = posters.select(plain_title(F.col("title")).alias("known"), kind.alias("kind"), "poster_path")
    known = known.filter("known <> '' and kind is not null and poster_path is not null")
    known = known.groupBy("known").agg(F.min(F.struct("kind", "known", "poster_path")).alias("poster"))
    counts = known.select(F.explode(_grams(F.col("known"))).alias("gram")).groupBy("gram").agg(F.count(F.lit(1)).alias("titles"))
    plain = asked.select("plain").distinct()
    left = _rarest(plain, counts, "plain", allowed_edits(F.col("plain")))
    right = _rarest(known.select("known"), counts, "known", F.lit(MOST_EDITS))
    met = left.join(right, "gram").select("plain", "known").distinct()
    distance = F.levenshtein(F.col("plain"), F.col("known"), MOST_EDITS)
    near = met.withColumn("edits", distance).filter((F.col("edits") >= 0) & (F.col("edits") <= allowed_edits(F.col("plain"))))
    best = lookup(near, known, ["known"]).groupBy("plain").agg(F.min(F.struct("edits", "poster")).alias("best"))
    return lookup(asked, best, ["plain"]).filter("best is not null").select(
        "title", F.col("best.poster.poster_path").alias("poster_path"), F.col("best.edits").alias("edits")
    )
