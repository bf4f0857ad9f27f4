"""Near-duplicates by HyperMinHash.

A document's set is its distinct five-word shingles (A-Z lower-cased). The sketch has
``REGISTERS`` buckets; each keeps, of the smallest hash that falls into it, the count of
leading zeros and ``MANTISSA`` bits after them, 16 bits in all. An empty bucket takes the
register of another one, in an order that is the same for all documents.

1. Documents with equal sets form a class; from here on only one of each counts.
2. Registers are banded in fours. Classes that agree in a band meet under the smallest
   class of that band, the hub, so a group has one row for each member and hub, not one for
   each band or pair.
3. Inside a group (large ones are dealt into blocks) the Jaccard similarity is estimated
   from the registers, corrected for chance collisions, and only a maximum spanning
   forest of the estimates is kept: as many pairs as members.
4. These pairs are verified on full sets; the verified ones give components.
5. Where a group still has members of several components, all pairs across components
   that the estimate does not rule out are verified as well, block against block, as
   products of 0/1 matrices; each task returns a forest of the links it found. So no link
   between components is lost, and no group ever lists its pairs.
6. A document's component is the smallest id in it.

Chances of a miss: two sets with similarity 0.85 agree in one of 32 bands with a
probability above 1 - 1e-9, and the estimate is compared with 0.85 less five standard
deviations.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from holdfast.llm.components import components
from holdfast.llm.store import stored
from holdfast.llm.textarrays import mix, row_slices, utf8, window_hashes, words
from holdfast.operators.joins import lookup

SHINGLE = 5
REGISTERS, MANTISSA, PER_BAND = 128, 10, 4
BLOCK = 128  # members of a group that are compared in one piece
_COLUMNS = 4_096  # hashes in one matrix product

_U64 = np.uint64
_BUCKET_BITS = REGISTERS.bit_length() - 1
_EDGES = (np.arange(REGISTERS + 1, dtype=object) << (64 - _BUCKET_BITS)).tolist()[1:-1]
_EDGES = np.array(_EDGES, _U64)
# The order in which an empty bucket looks for another one, from a fixed seed.
_PROBES = np.argsort(np.random.default_rng(20240101).random((REGISTERS, REGISTERS)), axis=1)
# Two unequal minima get one register if zeros and mantissa agree: the sum over zeros.
_COLLISION = sum(4.0 ** -(z + 1) for z in range(53)) / (1 << MANTISSA)


def shingle_sets(data: np.ndarray, offsets: np.ndarray) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each row."""
    found = words(data, offsets, lower=True)
    hashes = window_hashes(found.hashes, SHINGLE)
    first = np.searchsorted(found.row, np.arange(len(offsets)))
    for start, end in zip(first[:-1].tolist(), first[1:].tolist()):
        if end - start >= SHINGLE:
            yield np.unique(hashes[start : end - SHINGLE + 1])
        elif end > start:
            yield window_hashes(found.hashes[start:end], end - start)
        else:
            yield np.empty(0, _U64)


def registers(hashes: np.ndarray) -> np.ndarray:
    """The HyperMinHash registers of a sorted set that is not empty."""
    starts = np.concatenate(([0], np.searchsorted(hashes, _EDGES), [len(hashes)]))
    filled = starts[:-1] < starts[1:]
    least = hashes[np.minimum(starts[:-1], len(hashes) - 1)]
    rest = (least << _U64(_BUCKET_BITS)) >> _U64(11)  # 53 bits, exact as double
    bits = np.frexp(rest.astype(np.float64))[1]
    zeros = 53 - bits
    tail = (rest << (zeros + 12).astype(_U64)) >> _U64(64 - MANTISSA)  # after the leading one
    value = ((zeros.astype(_U64) << _U64(MANTISSA)) | tail).astype(np.uint16)
    if not filled.all():
        source = _PROBES[np.arange(REGISTERS), filled[_PROBES].argmax(axis=1)]
        value = np.where(filled, value, value[source])
    return value


def jaccard_estimates(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Estimates for all pairs of rows, corrected for chance collisions."""
    same = np.zeros((len(left), len(right)), np.uint8)
    for k in range(REGISTERS):
        same += left[:, k, None] == right[None, :, k]
    return (same / REGISTERS - _COLLISION) / (1 - _COLLISION)


def _possible(estimate: np.ndarray, n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """Pairs that neither the estimate nor the set sizes rule out."""
    small, large = np.minimum(n_left[:, None], n_right), np.maximum(n_left[:, None], n_right)
    need = percent / 100
    slack = 5 * np.sqrt(need * (1 - need) / np.minimum(small, REGISTERS))
    return (estimate >= need - slack) & (100 * small >= percent * large)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = utf8(batch.column("text"))
        sizes, first, second, sketches = [], [], [], []
        for low, high in row_slices(offsets):
            part = data[offsets[low] : offsets[high]]
            for hashes in shingle_sets(part, offsets[low : high + 1] - offsets[low]):
                sizes.append(len(hashes))
                # Sums of two mixes stand for the set in any order.
                first.append(int(mix(hashes ^ _U64(1)).sum(dtype=_U64).view(np.int64)))
                second.append(int(mix(hashes ^ _U64(2)).sum(dtype=_U64).view(np.int64)))
                sketches.append(registers(hashes).astype("<u2").tobytes() if len(hashes) else b"")
        columns = [batch.column("rid"), batch.column("doc_id"), pa.array(sizes, pa.int64())]
        columns += [pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(sketches, pa.binary())]
        yield pa.record_batch(columns, names=["rid", "doc_id", "n", "s1", "s2", "sketch"])


def _forest(groups: pa.Table, percent: int) -> pa.Table:
    """A maximum spanning forest of the possible pairs of one block, as pairs."""
    ids = groups["cid"].to_numpy()
    sketch = np.frombuffer(b"".join(groups["sketch"].to_pylist()), "<u2").reshape(-1, REGISTERS)
    n = groups["n"].to_numpy()
    estimate = jaccard_estimates(sketch, sketch)
    estimate = np.where(_possible(estimate, n, n, percent), estimate, -1.0)
    open_ = np.ones(len(ids), bool)
    best, parent = np.full(len(ids), -2.0), np.zeros(len(ids), np.int64)
    pairs: list[tuple[int, int]] = []
    for _ in range(len(ids)):
        near = int(np.where(open_, best, -3.0).argmax())
        if best[near] >= 0:
            pairs.append((int(ids[parent[near]]), int(ids[near])))
        open_[near] = False
        closer = open_ & (estimate[near] > best)
        best[closer], parent[closer] = estimate[near][closer], near
    return _pairs(pairs)


def _wanted(groups: pa.Table, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Members of two blocks (or one), and which pairs across components are possible."""
    side = groups["side"].to_numpy()
    sketch = np.frombuffer(b"".join(groups["sketch"].to_pylist()), "<u2").reshape(-1, REGISTERS)
    n, label = groups["n"].to_numpy(), groups["label"].to_numpy()
    left = np.flatnonzero(side == 0)
    right = left if groups["low"][0] == groups["high"][0] else np.flatnonzero(side == 1)
    possible = _possible(jaccard_estimates(sketch[left], sketch[right]), n[left], n[right], percent)
    return left, right, possible & (label[left][:, None] != label[right])


def _open_members(groups: pa.Table, percent: int) -> pa.Table:
    """The members that are in a possible pair across components."""
    left, right, wanted = _wanted(groups, percent)
    stays = np.union1d(left[wanted.any(axis=1)], right[wanted.any(axis=0)])
    return groups.take(pa.array(stays))


def _across(groups: pa.Table, percent: int) -> pa.Table:
    """Links between different components in two blocks: a forest of them, on full sets, as pairs of labels."""
    left, right, wanted = _wanted(groups, percent)
    n, label = (groups[c].to_numpy() for c in ("n", "label"))
    sets = list(shingle_sets(*utf8(groups["text"].combine_chunks())))
    shared = _shared(sets, left, right)
    wanted &= 100 * shared >= percent * (n[left][:, None] + n[right] - shared)
    joined: dict[int, int] = {}

    def head(x: int) -> int:
        while joined.get(x, x) != x:
            x = joined[x]
        return x

    pairs = []
    for i, j in np.argwhere(wanted):
        i, j = left[i], right[j]
        one, other = head(int(label[i])), head(int(label[j]))
        if one != other:
            joined[max(one, other)] = min(one, other)
            pairs.append((int(label[i]), int(label[j])))
    return _pairs(pairs)


def _shared(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right.

    Products of 0/1 matrices over the hashes that occur in more than one set.
    """
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    values, column, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    place = np.cumsum(count > 1) - 1
    several = count[column] > 1
    owner, column = owner[several], place[column[several]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    total = np.zeros((len(left), len(right)))
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, _COLUMNS):
        some = slice(*np.searchsorted(column, (low, low + _COLUMNS)))
        held = np.zeros((len(sets), _COLUMNS), np.float32)
        held[owner[some], column[some] - low] = 1
        total += held[left] @ held[right].T
    return np.rint(total).astype(np.int64)


def _pairs(pairs: list[tuple[int, int]]) -> pa.Table:
    a = pa.array([min(p) for p in pairs], pa.int64())
    return pa.table({"a": a, "b": pa.array([max(p) for p in pairs], pa.int64())})


def _verified(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = np.zeros(batch.num_rows, bool)
            for i in range(batch.num_rows):
                both = pa.concat_arrays([batch.column(c).slice(i, 1) for c in ("text_a", "text_b")])
                left, right = shingle_sets(*utf8(both))
                shared = len(np.intersect1d(left, right, assume_unique=True))
                linked[i] = 100 * shared >= percent * (len(left) + len(right) - shared)
            yield batch.select(["a", "b"]).filter(pa.array(linked))

    first = texts.select(F.col("rid").alias("a"), F.col("text").alias("text_a"))
    second = texts.select(F.col("rid").alias("b"), F.col("text").alias("text_b"))
    joined = lookup(lookup(pairs.distinct(), first, ["a"]), second, ["b"])
    return stored(joined.select("a", "b", "text_a", "text_b").mapInArrow(verify, "a bigint, b bigint"), "verified")


def near_duplicates(docs: DataFrame, percent: int = 80, keep: Sequence[str] = ()) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, and ``keep``.

    Two documents are linked if 100 * shared >= percent * union of their sets; a text of
    fewer than five words is one shingle, a null text or one without words is linked
    with nothing. ``component_id`` is the smallest ``doc_id`` of the component (nulls
    last); ``kept`` marks one row of each component, the one with that id (of repeated ids,
    the first). ``keep`` names further columns to return, which win over new ones of the same name. Rows are numbered once and
    written with their numbers, since a scan that is run again may be split otherwise.
    """
    # The kept columns travel in a struct, so none has the name of a new one.
    others = [c for c in keep if c not in ("doc_id", "text")]
    row = [F.struct(*others).alias("row")] if others else []
    numbered = stored(docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "text", *row), "numbered")
    schema = StructType.fromDDL("rid bigint, doc_id bigint, n bigint, s1 bigint, s2 bigint, sketch binary")
    sent = numbered.select("rid", F.col("doc_id").cast("bigint"), "text")
    sketches = stored(sent.mapInArrow(_sketch, schema), "sketches")
    same_set = ["s1", "s2", "n"]
    by_set = sketches.filter("n > 0").groupBy(*same_set)
    classes = stored(by_set.agg(F.min("rid").alias("cid"), F.count(F.lit(1)).alias("copies")), "classes")
    members = _groups(sketches, classes)
    class_label = lookup(classes, _labels(numbered, members, percent), ["cid"])
    class_label = class_label.select(*same_set, F.coalesce("label", "cid").alias("label"))
    placed = lookup(sketches.drop("sketch"), class_label, same_set)
    placed = placed.withColumn("label", F.coalesce("label", F.col("rid")))
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "rid")
    heads = placed.groupBy("label").agg(F.min(order).alias("head"))
    result = lookup(placed, heads, ["label"]).select(
        "rid",
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.col("head.doc_id").alias("component_id"),
        (F.col("head.rid") == F.col("rid")).alias("kept"),
    )
    if not keep:
        return result.drop("rid")
    new = [c for c in result.columns if c not in ("rid", "doc_id") and c not in keep]
    if "doc_id" not in keep:
        new.insert(0, "doc_id")
    joined = numbered.join(result.drop("doc_id"), "rid")
    return joined.select(*(F.col("row")[c].alias(c) if c in others else c for c in keep), *new)


def _groups(sketches: DataFrame, classes: DataFrame) -> DataFrame:
    """``hub``, ``cid``, ``n``, ``sketch``: classes that agree in a band, under their hub."""
    only = sketches.select(F.col("rid").alias("cid"), "n", "sketch").join(classes.select("cid"), "cid")
    width = 2 * PER_BAND
    bands = [
        F.xxhash64(F.lit(i), F.expr(f"substring(sketch, {i * width + 1}, {width})"))
        for i in range(REGISTERS // PER_BAND)
    ]
    banded = only.select("cid", F.explode(F.array(*bands)).alias("band"))
    hubs = banded.groupBy("band").agg(F.min("cid").alias("hub"), F.count(F.lit(1)).alias("size"))
    met = lookup(banded, hubs.filter("size > 1").select("band", "hub"), ["band"]).filter("hub is not null")
    return stored(lookup(met.select("hub", "cid").distinct(), only, ["cid"]), "groups")


def _labels(numbered: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``cid`` and ``label``, the smallest class of its component, of the classes in groups of several."""
    involved = members.select(F.col("cid").alias("rid")).distinct()
    # By sorting at every size: whether the ids fit a broadcast should not change the plan.
    texts = stored(numbered.select("rid", "text").join(involved.hint("merge"), "rid"), "group-texts")
    sizes = members.groupBy("hub").agg(F.count(F.lit(1)).alias("size"))
    sized = lookup(members, sizes, ["hub"])
    blocks = F.ceil(F.col("size") / BLOCK)
    block = F.pmod(F.xxhash64("cid", "hub"), blocks).cast("int")
    dealt = sized.filter("size > 1").withColumn("block", block)
    kinds = "a bigint, b bigint"
    forest = dealt.groupBy("hub", "block").applyInArrow(lambda t: _forest(t, percent), kinds)
    links = _verified(forest, texts, percent)
    labels = components(links).select(F.col("node").alias("cid"), "label")
    known = stored(lookup(dealt, labels, ["cid"]).withColumn("label", F.coalesce("label", "cid")), "labelled")
    paired = _paired(known)
    block_pair = ["hub", "low", "high"]
    open_ = paired.groupBy(*block_pair).applyInArrow(lambda t: _open_members(t, percent), paired.schema)
    with_text = lookup(stored(open_, "open-members"), texts.withColumnRenamed("rid", "cid"), ["cid"])
    across = with_text.groupBy(*block_pair).applyInArrow(lambda t: _across(t, percent), kinds)
    # These links join whole components, so only their labels are put together once more.
    merged = components(stored(across, "links-across")).select(F.col("node").alias("label"), F.col("label").alias("merged"))
    placed = lookup(known.select("cid", "label").distinct(), merged, ["label"])
    return placed.select("cid", F.coalesce("merged", "label").alias("label"))


def _paired(known: DataFrame) -> DataFrame:
    """Members of groups with several components, once for each pair of blocks that they are compared in.

    A group's largest component has blocks of its own, and its members need no comparison
    with each other; the rest is compared with all. So what is sent grows with the largest
    component times the blocks of the rest, not with the square of the group.
    """
    by_label = known.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n"))
    largest = F.max(F.struct("n", F.col("label").alias("main"))).alias("largest")
    hubs = by_label.groupBy("hub").agg(largest, F.sum("n").alias("members"))
    hubs = hubs.filter(F.col("members") > F.col("largest.n"))
    rest = lookup(known.select("hub", "cid", "n", "label", "sketch"), hubs, ["hub"]).filter("largest is not null")
    is_main = F.col("label") == F.col("largest.main")
    main_blocks = F.ceil(F.col("largest.n") / BLOCK).cast("int")
    rest_blocks = F.ceil((F.col("members") - F.col("largest.n")) / BLOCK).cast("int")
    place = F.xxhash64("cid", "hub")
    block = F.when(is_main, F.pmod(place, main_blocks)).otherwise(main_blocks + F.pmod(place, rest_blocks))
    first = F.when(is_main, main_blocks).otherwise(F.lit(0))
    others = F.explode(F.sequence(first, main_blocks + rest_blocks - 1))
    return rest.withColumn("block", block.cast("int")).withColumn("other", others).select(
        "hub",
        "cid",
        "n",
        "label",
        "sketch",
        F.least("block", "other").alias("low"),
        F.greatest("block", "other").alias("high"),
        (F.col("block") > F.col("other")).cast("int").alias("side"),
    )


def keep_one(docs: DataFrame, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, columns unchanged."""
    # Other columns travel in a struct, so none has the name of a new one, and the text is written once.
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    row = [F.struct(*others).alias("row")] if others else []
    renamed = docs.select("doc_id", "text", *row)
    found = near_duplicates(renamed, percent, keep=renamed.columns).filter("kept")
    return found.select(*(F.col("row")[c].alias(c) if c in others else c for c in docs.columns))
