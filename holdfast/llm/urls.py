"""URL rules by Bloom filter cascade: exact membership of a fixed key universe, without joins.

A rule is a host and the beginning of a path. It fits its host and all subdomains
when the url's path starts with the rule's. The keys a url can match are the ends of
its host, label by label, joined with beginnings of its path, and only in the
shapes (labels, path length) that occur among the rules. The keys of all urls form
the universe.

A cascade encodes a set of listed keys against that universe. Level 0 is a Bloom
filter of the listed keys; level 1 one of the universe's keys that level 0 takes
wrongly for listed; level 2 one of the listed keys that level 1 takes wrongly, and so
on until nothing is taken wrongly. A key of the universe is decided by the first level
that does not hold it. The filters are arrays of 64-bit words in one-row tables, used
as scalar subqueries, so urls are judged in the scan, in generated code.

The size of the filters is bounded by the rule list, not by the corpus: level 0 takes
``BITS`` bits a rule, later levels shrink. ``MAX_WORDS`` is checked before anything is
sent to executors; a list beyond it (about 50 million rules) raises an error.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.llm.columns import unused
from holdfast.llm.store import stored

BITS, HASHES, LEAST_WORDS, MAX_WORDS = 10, 4, 16, 8_000_000
MAX_SHAPES = 256

Rule = tuple[str, str, str]  # verdict, host, beginning of the path


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host, path = (F.coalesce(F.regexp_extract(url, pattern, i), F.lit("")) for i in (1, 2))
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def candidate_key(host: Column, path: Column, labels: int, length: int) -> Column:
    """The key of one shape, null where the url is too short for it."""
    parts = F.split(host, r"\.", -1)
    end = F.substring_index(host, ".", -labels)
    fits = (F.size(parts) >= labels) & (F.length(path) >= length)
    return F.when(fits, F.concat(end, F.substring(path, 1, length)))


def _positions(key: Column, level: int, words: int) -> list[Column]:
    return [
        F.pmod(F.xxhash64(key, F.lit(level), F.lit(i)), F.lit(words * 64)) for i in range(HASHES)
    ]


def _level_table(keys: DataFrame, level: int, words: int) -> DataFrame:
    """One row with the filter of ``keys`` as an array of ``words`` longs."""
    bit = F.explode(F.array(*_positions(F.col("key"), level, words))).alias("at")
    set_bits = (
        keys.select(bit)
        .groupBy((F.col("at") / 64).cast("int").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 64 as int))")).alias("bits"))
    )
    empty = keys.sparkSession.range(words).select(
        F.col("id").cast("int").alias("word"), F.lit(0).cast("long").alias("bits")
    )
    dense = set_bits.unionByName(empty).groupBy("word").agg(F.bit_or("bits").alias("bits"))
    filled = dense.agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("all"))
    return stored(filled.select(F.col("all.bits").alias("bits")), "url-filter")


class Cascade:
    """The filters of one list of keys over one universe."""

    def __init__(self, listed: DataFrame, universe: DataFrame):
        """``listed`` and ``universe`` have a column ``key``; repeats and nulls do not matter."""
        self.levels: list[tuple[DataFrame, int]] = []
        listed = listed.select("key").filter("key is not null").distinct()
        count = listed.count()
        if not count:
            return
        self._add(listed, count)
        # Keys that pass level 0: the only ones all further levels deal with.
        passing = universe.select("key").filter(self._holds(F.col("key"), 0)).distinct()
        both = listed.select("key", F.lit(True).alias("listed")).unionByName(
            passing.select("key", F.lit(False).alias("listed"))
        )
        rest = stored(both.groupBy("key").agg(F.max("listed").alias("listed")), "url-keys")
        while True:
            encoded_listed = len(self.levels) % 2 == 0
            wrong = rest.filter(F.col("listed") == encoded_listed)
            for level in range(1, len(self.levels)):
                wrong = wrong.filter(self._holds(F.col("key"), level))
            count = wrong.count()
            if not count:
                return
            self._add(wrong, count)

    def _add(self, keys: DataFrame, count: int) -> None:
        words = max(LEAST_WORDS, -(-count * BITS // 64))
        if words > MAX_WORDS:
            raise ValueError(f"{count} keys need a filter of {words * 8} bytes")
        level = len(self.levels)
        self.levels.append((_level_table(keys, level, words), words))

    def _holds(self, key: Column, level: int) -> Column:
        table, words = self.levels[level]
        bits = table.scalar()
        return reduce(
            and_,
            (
                F.expr("1L").bitwiseAND(
                    F.call_function(
                        "shiftright", F.get(bits, (at / 64).cast("int")), (at % 64).cast("int")
                    )
                )
                == 1
                for at in _positions(key, level, words)
            ),
        )

    def member(self, key: Column) -> Column:
        """Whether ``key``, one of the universe or null, is listed."""
        result = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            result = F.when(self._holds(key, level), result).otherwise(level % 2 == 1)
        return key.isNotNull() & result


def judge_urls(pages: DataFrame, rules: Sequence[Rule], url: str = "url") -> DataFrame:
    """Add ``host``, ``path``, ``rule`` and ``verdict`` to every row.

    The longest fitting rule decides (of two of one length, the greater text; of
    equal rules, block). Without a fitting rule ``rule`` is null and the verdict is
    allow, as no key of the url is listed. Null and empty urls, urls without
    ``://``, repeated rows and an empty table are judged like any other; columns of
    ``pages`` that have one of the new names are replaced.
    """
    spark = pages.sparkSession
    host, path = url_parts(F.col(url))
    shapes = sorted({(h.count(".") + 1, len(p)) for _, h, p in rules})
    if len(shapes) > MAX_SHAPES:
        raise ValueError(f"the rules have {len(shapes)} shapes, at most {MAX_SHAPES} are supported")
    parted = pages.withColumns({"host": host, "path": path})
    keys = [candidate_key(F.col("host"), F.col("path"), *shape) for shape in shapes]
    if not keys:
        return parted.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit("allow")})
    universe = parted.select(F.explode(F.array(*keys)).alias("key")).filter("key is not null")
    found = []
    for verdict in ("allow", "block"):
        listed = "\0".join(h + p for v, h, p in rules if v == verdict)
        listing = spark.range(1).select(F.explode(F.split(F.lit(listed), "\0")).alias("key"))
        cascade = Cascade(listing.filter("key != ''"), universe)
        found += [
            F.when(
                cascade.member(key),
                F.struct(F.length(key).alias("n"), key.alias("key"), F.lit(verdict).alias("verdict")),
            )
            for key in keys
        ]
    best = F.greatest(*found) if len(found) > 1 else found[0]
    chosen = unused("best", parted.columns)
    judged = parted.withColumn(chosen, best)
    return judged.withColumns(
        {
            "rule": F.col(chosen)["key"],
            "verdict": F.coalesce(F.col(chosen)["verdict"], F.lit("allow")),
        }
    ).drop(chosen)
