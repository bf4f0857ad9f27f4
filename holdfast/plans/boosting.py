"""Gradient boosting on histograms, with early stopping by the precision-recall area.

Features are cut into bins once and rows are stored as blocks of bin numbers. For each level
of a tree one job adds up gradients and hessians per (node, feature, bin): tasks fill one
histogram each, partial sums of many tasks are combined on the executors, and the driver gets histograms
of fixed size, picks the splits and sends them with the next job. Nothing that grows with the rows reaches the
driver. Margins are carried along in the blocks and renewed every ``SYNC`` rounds.

Gradients are added as integers of a fixed scale, so the model does not depend on
how rows are dealt or on the order of sums. The number of tasks follows the rows and the cores.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from math import ceil, log2
from operator import add

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.forest import Forest, matrix, probabilities
from holdfast.operators.aggregates import class_weight
from holdfast.session import ensure_checkpoint_dir, materialise

SYNC, RENEWALS = 10, 5  # rounds between renewals of the margins; renewals between checkpoints
BLOCK = 1 << 16
DIRECT = 16  # tasks, at most, whose histograms go to the driver one by one; those of more are added up before
BIN_SAMPLE = 200_000  # rows, about, that decide where bins are cut; all rows are fitted
_STEPS, _REACH = 1 << 10, 16  # margins are ranked in steps of 1/1024, from -16 to 16
_LEAST_GAIN, _SAME_GAIN = 1e-6, 1e-9


@dataclass(frozen=True)
class BoostParams:
    """Settings of the trees; ``rounds`` is the most, or all where no rows can stop them."""

    rounds: int = 1_000
    patience: int = 50
    max_depth: int = 5
    step_size: float = 0.05
    weight_factor: float = 1.0
    l2: float = 1.0
    min_child_weight: float = 1.0
    bins: int = 256
    rows_per_task: int = 1_000_000


class Block:
    """Some rows: bins (a line for each feature), labels, and the margins so far."""

    def __init__(self, bins: np.ndarray, label: np.ndarray, margin: np.ndarray):
        self.bins, self.label, self.margin = bins, label, margin

    def margins(self, trees: Forest) -> np.ndarray:
        total = self.margin.copy()
        for value in trees.leaves(self.bins):
            total += value
        return total


def bin_cuts(rows: DataFrame, inputs: Sequence[str], bins: int, count: int) -> list[np.ndarray]:
    """Upper ends of all bins but the last, for each input.

    Every value is a bin where there are few enough, else bins hold about as many rows each. Rows
    are chosen by a hash of their contents, so the cuts do not depend on their order.
    """
    every = max(1, -(-count // BIN_SAMPLE))
    values = rows.select(*(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(inputs)))
    chosen = values.filter(F.pmod(F.xxhash64(*values.columns), F.lit(every)) == 0).toArrow()
    cuts = []
    for name in values.columns:
        found = np.nan_to_num(chosen[name].cast(pa.float64()).to_numpy(), nan=0.0)
        distinct = np.unique(found)
        if len(distinct) > bins:
            at = (np.arange(1, bins) * len(found)) // bins
            distinct = np.unique(np.append(np.sort(found)[at], distinct[-1]))
        cuts.append(distinct[:-1])
    return cuts


def blocks(rows: DataFrame, inputs: Sequence[str], cuts: Sequence[np.ndarray], tasks: int) -> RDD:
    """The rows as :class:`Block`, dealt to ``tasks`` tasks and stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f"_{i}" for i in range(len(inputs))]
        held, size = [], 0

        def put() -> pa.RecordBatch:
            bins = np.concatenate([b for b, _ in held], axis=1)
            label = np.concatenate([x for _, x in held])
            held.clear()
            return pa.record_batch([pa.array([bins.tobytes()]), pa.array([label.tobytes()])], names=["bins", "label"])

        for batch in batches:
            values = matrix(batch, names)
            bins = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, values)]).astype(np.uint8)
            held.append((bins, batch.column("label").to_numpy(zero_copy_only=False).astype(np.uint8)))
            size += batch.num_rows
            if size >= BLOCK:
                yield put()
                size = 0
        if size:
            yield put()

    sent = rows.select(*(F.col(c).cast("double").alias(f"_{i}") for i, c in enumerate(inputs)), "label")
    stored = materialise(sent.repartition(tasks).mapInArrow(run, "bins binary, label binary"))

    def block(row) -> Block:
        label = np.frombuffer(row["label"], np.uint8)
        bins = np.frombuffer(row["bins"], np.uint8).reshape(len(inputs), -1)
        return Block(bins, label, np.zeros(len(label)))

    return stored.rdd.map(block).persist(StorageLevel.MEMORY_AND_DISK)


def histogram(block: Block, tree: Forest, level: int, asked: np.ndarray, weight: float, scale: float, sizes: Sequence[int]) -> np.ndarray:
    """Sums of gradient and hessian per (node of the level in ``asked``, bin of any feature), as integers.

    ``sizes`` are the numbers of bins of the features, which lie one after the other.
    """
    chance = probabilities(block.margin)
    factor = np.where(block.label == 1, weight, 1.0) * scale
    sums = np.rint((chance - block.label) * factor), np.rint(chance * (1 - chance) * factor)
    place = np.zeros(len(chance), np.int64)
    at = np.arange(len(chance))
    flat = block.bins.reshape(-1)
    for _ in range(level):
        of = tree.feature[0].take(place)
        right = flat.take(of * len(chance) + at) > tree.cut[0].take(place)
        place = np.where(of >= 0, 2 * place + 1 + right, place)  # rows in leaves stay
    line = np.full(tree.feature.shape[1], -1)
    line[asked] = np.arange(len(asked))
    node = line.take(place)
    at = np.flatnonzero(node >= 0)
    width = sum(sizes)
    node, sums = node[at] * width, tuple(s[at] for s in sums)
    out = np.zeros((2, len(asked) * width), np.int64)
    for of_row, start in zip(block.bins, np.cumsum([0, *sizes])):
        cell = node + of_row[at]
        cell += start
        for k, s in enumerate(sums):  # exact: a block's sums stay below 2**53
            out[k] += np.bincount(cell, s, out.shape[1]).astype(np.int64)
    return out.reshape(2, len(asked), width)


def _tree(data: RDD, recent: Forest, weight: float, scale: float, sizes: Sequence[int], params: BoostParams) -> Forest:
    """Grow one tree on bins: a job for each level.

    The margins of the recent trees are added once, with the first level. Of two children only the one with
    fewer hessians is summed up; the other is the rest of their parent, exactly.
    """
    size = (2 << params.max_depth) - 1
    feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
    used = (np.arange(params.bins) < np.array(sizes)[:, None]).reshape(-1)
    live = asked = np.zeros(1, np.int64)
    parents = None
    current = data.map(lambda b: Block(b.bins, b.label, b.margins(recent))).persist(StorageLevel.MEMORY_AND_DISK)
    depth = 1 if data.getNumPartitions() <= DIRECT else 2
    for level in range(params.max_depth):
        tree = Forest(recent.inputs, feature[None].copy(), cut[None].copy(), value[None].copy())
        fixed = (tree, level, asked, weight, scale, sizes)

        def sums(some: Iterator[Block], fixed=fixed) -> Iterator[np.ndarray]:
            total = None
            for block in some:
                found = histogram(block, *fixed)
                total = found if total is None else total + found
            if total is not None:
                yield total

        found = current.mapPartitions(sums).treeReduce(add, depth)
        if parents is not None:
            both, summed = np.repeat(parents, 2, axis=1), np.isin(live, asked)
            both[:, summed], both[:, ~summed] = found, parents - found
            found = both
        whole = np.zeros((2, len(live), len(used)), np.int64)
        whole[:, :, used] = found
        g, h = whole.reshape(2, len(live), len(sizes), params.bins) / scale
        left_g, left_h = np.cumsum(g, axis=2), np.cumsum(h, axis=2)
        all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
        right_g, right_h = all_g - left_g, all_h - left_h
        gain = left_g**2 / (left_h + params.l2) + right_g**2 / (right_h + params.l2) - all_g**2 / (all_h + params.l2)
        gain[(left_h < params.min_child_weight) | (right_h < params.min_child_weight)] = -np.inf
        flat = gain.reshape(len(live), -1)
        best = (flat >= flat.max(axis=1)[:, None] - _SAME_GAIN).argmax(axis=1)  # of equal gains the first feature and bin
        children, fewer, split = [], [], []
        for i, place in enumerate(live.tolist()):
            f, b = divmod(int(best[i]), params.bins)
            value[place] = -params.step_size * all_g[i, 0, 0] / (all_h[i, 0, 0] + params.l2)
            if gain[i, f, b] > _LEAST_GAIN:
                feature[place], cut[place] = f, b
                for child, cg, ch in ((2 * place + 1, left_g, left_h), (2 * place + 2, right_g, right_h)):
                    value[child] = -params.step_size * cg[i, f, b] / (ch[i, f, b] + params.l2)
                    children.append(child)
                fewer.append(2 * place + 1 + int(right_h[i, f, b] < left_h[i, f, b]))
                split.append(i)
        live, asked, parents = np.array(children, np.int64), np.array(fewer, np.int64), found[:, split]
        if not len(live):
            break
    current.unpersist()
    return Forest(recent.inputs, feature[None], cut[None], value[None])


def _joined(forests: Sequence[Forest], inputs: tuple[str, ...], depth: int) -> Forest:
    if not forests:
        size = (2 << depth) - 1
        return Forest(inputs, np.empty((0, size), np.int64), np.empty((0, size)), np.empty((0, size)))
    return Forest(inputs, *(np.concatenate([getattr(f, c) for f in forests]) for c in ("feature", "cut", "value")))


def _renewed(data: RDD, trees: Forest, cut_lineage: bool) -> RDD:
    """The blocks with the trees' margins added."""
    new = data.map(lambda b: Block(b.bins, b.label, b.margins(trees))).persist(StorageLevel.MEMORY_AND_DISK)
    if cut_lineage:
        new.checkpoint()
    new.count()
    data.unpersist()
    return new


def precision_recall_area(counts: np.ndarray) -> float:
    """Area of the steps, from counts of (negative, positive) rows by margin, lowest first."""
    negative, positive = np.cumsum(counts[:, ::-1], axis=1)
    precision = positive / np.maximum(positive + negative, 1)
    return float((np.diff(positive, prepend=0) * precision).sum() / max(positive[-1], 1))


def _areas(late: RDD, recent: Forest) -> list[float]:
    """The area after each of the recent rounds; a histogram of fixed size for each reaches the driver."""

    def count(some: Iterator[Block]) -> Iterator[np.ndarray]:
        cells = 2 * _REACH * _STEPS + 1
        total = np.zeros((recent.rounds, 2, cells), np.int64)
        for block in some:
            margin = block.margin.copy()
            for k, value in enumerate(recent.leaves(block.bins)):
                margin += value
                cell = np.rint((np.clip(margin, -_REACH, _REACH) + _REACH) * _STEPS).astype(np.int64)
                total[k] += np.bincount(np.where(block.label == 1, cells, 0) + cell, minlength=2 * cells).reshape(2, cells)
        yield total

    return [precision_recall_area(c) for c in late.mapPartitions(count).treeReduce(add)]


def fit(rows: DataFrame, late: DataFrame | None, inputs: Sequence[str], params: BoostParams = BoostParams()) -> tuple[Forest, list[float]]:
    """Boosted trees for ``label`` (0 or 1), and the precision-recall area on ``late`` after each round.

    Positives weigh as much as the negatives, times ``weight_factor``. Fitting ends when the
    area has not risen for ``patience`` rounds, and the trees up to its best round are
    returned; without ``late`` all ``rounds`` are. ``rows`` should be stored. Null and NaN inputs are 0.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    weight = class_weight(rows, factor=params.weight_factor).first()["pos_weight"] or 1.0
    count, inputs = rows.count(), tuple(inputs)
    cuts = bin_cuts(rows, inputs, params.bins, count)
    # Below 2**53 within a block and 2**62 in all.
    scale = 2.0 ** min(36 - ceil(log2(max(weight, 1))), 62 - ceil(log2(max(count * max(weight, 1), 2))))
    cores, sizes = rows.sparkSession.sparkContext.defaultParallelism, [len(c) + 1 for c in cuts]
    data = blocks(rows, inputs, cuts, _tasks(count, params, cores))
    tests = blocks(late, inputs, cuts, _tasks(late.count(), params, cores)) if late is not None else None
    done: list[Forest] = []
    recent: list[Forest] = []
    areas: list[float] = []
    best = 0
    while len(done) + len(recent) < params.rounds:
        recent.append(_tree(data, _joined(recent, inputs, params.max_depth), weight, scale, sizes, params))
        if len(recent) < SYNC and len(done) + len(recent) < params.rounds:
            continue
        trees = _joined(recent, inputs, params.max_depth)
        cut_lineage = len(done) // SYNC % RENEWALS == RENEWALS - 1
        data = _renewed(data, trees, cut_lineage)
        done, recent = done + recent, []
        if tests is not None:
            areas += _areas(tests, trees)
            tests = _renewed(tests, trees, cut_lineage)
            best = _best_round(areas, params.patience)
            if len(areas) - best >= params.patience:
                break
    for rdd in (data, tests):
        if rdd is not None:
            rdd.unpersist()
    rounds = best if tests is not None else len(done)
    found = _joined(done[:rounds], inputs, params.max_depth)
    return _on_values(found, cuts), areas


def _tasks(count: int, params: BoostParams, cores: int) -> int:
    """One for ``rows_per_task`` rows, and as many as there are cores where each gets a whole block."""
    return max(1, -(-count // params.rows_per_task), min(cores, count // BLOCK))


def _best_round(areas: Sequence[float], patience: int) -> int:
    """The round of the largest area, up to the first ``patience`` rounds without a larger one."""
    best = 0
    for n, area in enumerate(areas):
        if area > areas[best]:
            best = n
        elif n - best >= patience:
            break
    return best + 1


def _on_values(trees: Forest, cuts: Sequence[np.ndarray]) -> Forest:
    """The same trees with cuts between values instead of bins."""
    cut = np.zeros_like(trees.cut)
    for f, upper in enumerate(cuts):
        some = trees.feature == f
        cut[some] = upper[trees.cut[some].astype(np.int64)]
    return Forest(trees.inputs, trees.feature, cut, trees.value)
