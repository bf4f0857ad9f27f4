"""How far each source's words are from those of its language: terms and other sources.

1. Tasks count terms by language and source before anything is shuffled, once by occurrence
   and once by document. One exchange by language and term then gives each source's count, the
   language's count and the documents, and decides which terms are kept. These cells are
   written; all that follows reads them.
2. Top terms. A source's value of a term rises with its own count and falls with the
   language's, whatever the totals are, and ties go to the earlier term. So a term that
   ``TOP`` others beat or equal in all three cannot be among the first ``TOP``: each
   partition keeps its skyband (the terms dominated by fewer), skybands are merged in
   blocks, and only what is left is given its exact value and rank.
3. Pairs. Sources of a language are numbered and dealt into blocks, terms into shards; a
   task fills two blocks' probabilities of one shard into matrices and sums the values of all
   their pairs. Terms that neither block has in a shard all have one value, and are added by
   their number.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.bytewords import byte_class
from holdfast.llm.store import stored
from holdfast.operators.joins import lookup

LEAST_DOCS, TOP = 10, 10
SOURCES, SHARD_TERMS = 64, 2_048  # sources of a block and, on average, terms of a shard
BAND_ROWS, MERGE_ROWS = 50_000, 50_000
_HELD_BYTES = 24 << 20  # of terms that a task counts before it sends them on
_PART = 1 << 20

_LETTERS = byte_class("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")
# A-Z in lower case, other letters as they are, everything else a space.
_FOLD = bytes(ord(chr(b).lower()) if b < 0x80 and m else b if m else 0x20 for b, m in enumerate(_LETTERS))
_CELLS = "lang string, source string, term string, n bigint, docs bigint"
_BAND = "lang string, source string, term string, n bigint, lang_n bigint"
_PAIRS = "lang string, source string, item string, kept bigint, p bigint, q bigint, value bigint, seen bigint"


def _term_parts(raw: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, about a megabyte at a time."""
    folded, at = raw.translate(_FOLD), 0
    while at < len(folded):
        end = at + _PART
        if end < len(folded):
            end = folded.find(b" ", end)
            end = len(folded) if end < 0 else end
        yield folded[at:end].split()
        at = end


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[tuple[str, str], tuple[Counter, Counter]] = {}
    held = 0

    def flush() -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, docs) in counts.items():
            terms = pa.array(n.keys(), pa.binary()).cast(pa.string())
            both = [pa.array(n.values(), pa.int64()), pa.array([docs[t] for t in n], pa.int64())]
            names = [pa.repeat(pa.scalar(x, pa.string()), len(n)) for x in (lang, source)]
            yield pa.record_batch([*names, terms, *both], names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(), texts):
            n, docs = counts.setdefault((lang, source), (Counter(), Counter()))
            before, seen = len(n), set()
            for terms in _term_parts(text.as_py()):
                n.update(terms)
                seen.update(terms)
            docs.update(seen)
            if len(n) > before:
                held += (len(n) - before) * 200 + sum(map(len, seen))  # about what new keys take
            if held > _HELD_BYTES:
                yield from flush()
                counts.clear()
                held = 0
    yield from flush()


def term_cells(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """``lang``, ``source``, ``term``, ``n``, ``lang_n`` of terms kept by their language; ``first`` marks one row a term."""
    found = docs.mapInArrow(_count_terms, _CELLS).repartition("lang", "term")
    # The exchange by language and term serves the sums by source and the window as well.
    cells = found.groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    of_term = Window.partitionBy("lang", "term")
    cells = cells.select(
        "lang",
        "source",
        "term",
        "n",
        F.sum("n").over(of_term).alias("lang_n"),
        F.sum("docs").over(of_term).alias("docs"),
        (F.col("source") == F.min("source").over(of_term)).alias("first"),
    )
    return cells.filter(F.col("docs") >= least_docs).drop("docs")


def skyband(n: np.ndarray, lang_n: np.ndarray, term: np.ndarray, k: int = TOP) -> np.ndarray:
    """Places that fewer than ``k`` others dominate: more ``n``, less ``lang_n``, smaller ``term`` (or equal)."""
    order = np.lexsort((term, lang_n, -n))  # a dominating place comes earlier
    lang_n, term = lang_n[order], term[order]
    kept = np.empty(0, np.int64)
    for low in range(0, len(order), 512):
        some = np.arange(low, min(low + 512, len(order)))
        over = np.zeros(len(some), np.int64)  # how many dominate each, of the band so far
        for at in range(0, len(kept), 8_192):
            near = kept[at : at + 8_192]
            over += ((lang_n[near] <= lang_n[some, None]) & (term[near] <= term[some, None])).sum(axis=1)
            some, over = some[over < k], over[over < k]
        inner = (lang_n[some] <= lang_n[some, None]) & (term[some] <= term[some, None]) & (some < some[:, None])
        kept = np.concatenate((kept, some[over + inner.sum(axis=1) < k]))
    return np.sort(order[kept])


def _bands(rows: pa.Table, k: int) -> pa.Table:
    """The skyband of each language and source."""
    rows = rows.combine_chunks()
    rank = np.empty(rows.num_rows, np.int64)
    rank[pc.sort_indices(rows["term"].cast(pa.binary())).to_numpy()] = np.arange(rows.num_rows)
    n, lang_n = rows["n"].to_numpy(), rows["lang_n"].to_numpy()
    codes = [np.asarray(rows[c].combine_chunks().dictionary_encode().indices) for c in ("lang", "source")]
    _, group = np.unique(np.stack(codes), axis=1, return_inverse=True)
    order = np.argsort(group, kind="stable")
    edges = np.flatnonzero(np.diff(group[order], prepend=-1))
    places = [part[skyband(n[part], lang_n[part], rank[part], k)] for part in np.split(order, edges[1:])]
    return rows.take(pa.array(np.concatenate(places)))


def _partition_bands(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        fresh = kept = 0
        for batch in batches:
            held.append(batch)
            fresh += batch.num_rows
            if fresh >= max(BAND_ROWS, kept):  # the band is made anew when as many rows have come
                band = _bands(pa.Table.from_batches(held), k)
                held, fresh, kept = band.to_batches(), 0, band.num_rows
                if kept > 10 * BAND_ROWS:
                    yield from held
                    held, kept = [], 0
        if held and sum(b.num_rows for b in held):
            yield from _bands(pa.Table.from_batches(held), k).to_batches()

    return run


def _share(count: str, total: str) -> Column:
    """1 + floor(10^9 (count + 2) / (total + 2 kept)), exact at any size."""
    return F.expr(
        f"1 + (cast({count} + 2 as decimal(20, 0)) * 1000000000bd) div cast({total} + 2 * kept as decimal(20, 0))"
    )


def _value(p: str, q: str) -> Column:
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div ({p} + {q})")


def top_terms(cells: DataFrame, groups: DataFrame, top: int = TOP) -> DataFrame:
    """The terms of most value for each source, ranked."""
    bands = stored(cells.select("lang", "source", "term", "n", "lang_n").mapInArrow(_partition_bands(top), _BAND), "skybands")
    sizes = bands.groupBy("lang", "source").agg(F.ceil(F.count(F.lit(1)) / MERGE_ROWS).alias("blocks"))
    dealt = lookup(bands, sizes, ["lang", "source"])
    block = F.pmod(F.xxhash64("term"), F.col("blocks")).alias("block")
    merged = dealt.select("lang", "source", "term", "n", "lang_n", block)
    merged = merged.groupBy("lang", "source", "block").applyInArrow(lambda t: _bands(t.drop_columns("block"), top), _BAND)
    valued = lookup(merged, groups.drop("number"), ["lang", "source"])
    valued = valued.withColumns({"p": _share("n", "total"), "q": _share("lang_n", "lang_total")}).filter("p > q")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term")
    ranked = valued.withColumn("value", _value("p", "q")).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= top).select("lang", "source", F.col("term").alias("item"), "value", "rank")


def _pair_values(rows: pa.Table) -> pa.Table:
    """Sums over one shard's terms for all pairs of two blocks' sources (or of one block's)."""
    lang, diagonal = rows["lang"][0].as_py(), rows["low"][0] == rows["high"][0]
    marks = pc.is_valid(rows["source"])
    about, cells = rows.filter(marks), rows.filter(pc.invert(marks))
    codes = cells["term"].combine_chunks().dictionary_encode()
    seen = len(codes.dictionary)
    code, side, number, p = np.asarray(codes.indices), *(cells[c].to_numpy() for c in ("side", "number", "p"))

    def block(of: int) -> tuple[np.ndarray, np.ndarray, list[str], np.ndarray]:
        own = about.filter(pc.equal(about["side"], of)).sort_by("number")
        numbers, absent = own["number"].to_numpy(), own["p"].to_numpy()
        matrix = np.repeat(absent[:, None], seen, axis=1)
        some = side == of
        matrix[np.searchsorted(numbers, number[some]), code[some]] = p[some]
        return numbers, absent, own["source"].to_pylist(), matrix

    left = block(0)
    right = left if diagonal else block(1)
    kept = about["kept"][0].as_py()
    out: list[tuple] = []
    for number_a, p_a, name_a, row in zip(*left):
        later = np.flatnonzero(right[0] > number_a)
        values = ((row - right[3][later]) ** 2 // (row + right[3][later])).sum(axis=1)
        for j, value in zip(later.tolist(), values.tolist()):
            pair = (int(p_a), int(right[1][j]), value, seen)
            out += [(lang, name_a, right[2][j], kept, *pair), (lang, right[2][j], name_a, kept, pair[1], pair[0], value, seen)]
    kinds = [pa.string()] * 3 + [pa.int64()] * 5
    columns = list(zip(*out)) if out else [()] * 8
    names = ["lang", "source", "item", "kept", "p", "q", "value", "seen"]
    return pa.table([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)


def source_pairs(cells: DataFrame, groups: DataFrame) -> DataFrame:
    """Every other source of the language for each source, ranked by the summed values of all kept terms."""
    absent = F.when(F.col("kept") > 0, _share("0", "total")).otherwise(F.lit(1))
    # Numbered from 0 within the language; each row knows how many blocks and shards there are.
    own = groups.select(
        "lang",
        "source",
        "number",
        "kept",
        "total",
        absent.alias("absent"),
        F.ceil(F.col("sources") / SOURCES).cast("int").alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.col("kept") / SHARD_TERMS)).cast("int").alias("shards"),
    )
    marks = own.withColumn("shard", F.explode(F.sequence(F.lit(0), F.col("shards") - 1))).withColumns(
        {"term": F.lit(None).cast("string"), "p": F.col("absent")}
    )
    shard = F.pmod(F.xxhash64("term"), F.col("shards")).cast("int")
    filled = lookup(cells.select("lang", "source", "term", "n"), own, ["lang", "source"])
    filled = filled.withColumns({"shard": shard, "p": _share("n", "total"), "source": F.lit(None).cast("string")})
    columns = ["lang", "source", "number", "kept", "blocks", "shard", "term", "p"]
    rows = marks.select(*columns).unionByName(filled.select(*columns))
    block = F.floor(F.col("number") / SOURCES).cast("int")
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "lang",
        F.least(block, "other").alias("low"),
        F.greatest(block, "other").alias("high"),
        "shard",
        (block > F.col("other")).cast("int").alias("side"),
        "number",
        "source",
        "kept",
        "term",
        "p",
    )
    sums = rows.groupBy("lang", "low", "high", "shard").applyInArrow(_pair_values, _PAIRS)
    sums = sums.groupBy("lang", "source", "item", "kept", "p", "q").agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    value = (F.col("value") + (F.col("kept") - F.col("seen")) * _value("p", "q")).alias("value")
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    return sums.select("lang", "source", "item", value).withColumn("rank", F.row_number().over(order))


def audit_sources(docs: DataFrame, least_docs: int = LEAST_DOCS, top: int = TOP) -> DataFrame:
    """``lang``, ``source``, ``part``, ``item``, ``value``, ``rank`` for every language and source of ``docs``.

    Terms are ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+`` of whole texts, only A-Z lower-cased. Null
    ``text``, ``lang`` and ``source`` are empty strings. A language keeps the terms that are in at least
    ``least_docs`` of its rows (repeated rows count each). Part ``pair`` ranks all other sources of the
    language, part ``term`` the ``top`` terms that the source uses more than its language; equal values
    are in order of the item's UTF-8. A source without kept terms has pairs only; where the
    language keeps none, their value is 0. An empty table gives no rows; other columns are not read.
    """
    names = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")]
    read = docs.select(*names)
    cells = stored(term_cells(read, least_docs), "term-cells")
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("kept"))
    of_lang = Window.partitionBy("lang")
    occurring = read.select("lang", "source").distinct().select(
        "lang",
        "source",
        (F.row_number().over(of_lang.orderBy("source")) - 1).alias("number"),
        F.count(F.lit(1)).over(of_lang).alias("sources"),
    )
    groups = lookup(lookup(occurring, totals, ["lang", "source"]), langs, ["lang"])
    groups = stored(groups.fillna(0, ["total", "lang_total", "kept"]), "sources")
    pairs = source_pairs(cells, groups).withColumn("part", F.lit("pair"))
    terms = top_terms(cells, groups, top).withColumn("part", F.lit("term"))
    return pairs.unionByName(terms).select("lang", "source", "part", "item", "value", "rank")
