import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from holdfast.functions import forest
from holdfast.plans import boosting

INPUTS = ["a", "b", "c"]
PARAMS = boosting.BoostParams(rounds=23, patience=6, max_depth=3, step_size=0.3)


def table(spark, seed, count, noise=0.2):
    r = np.random.default_rng(seed)
    x = np.stack([r.integers(0, 9, count), r.normal(size=count).round(1), r.integers(0, 3, count)]).astype(float)
    y = ((x[0] > 4) ^ (x[1] > 0.5) ^ (r.random(count) < noise)).astype(int)
    rows = spark.createDataFrame([(*map(float, v), int(k)) for v, k in zip(x.T, y)], "a double, b double, c double, label int")
    return rows, x, y


def grown(x, g, h, depth, p):
    """A tree by trying every cut of every feature, as (feature, cut, left, right) or a value."""
    leaf = -p.step_size * g.sum() / (h.sum() + p.l2)
    best = (1e-6, None, None)
    for f in range(len(x)) if depth else ():
        for cut in np.unique(x[f])[:-1]:
            left = x[f] <= cut
            gl, hl, gr, hr = g[left].sum(), h[left].sum(), g[~left].sum(), h[~left].sum()
            if hl >= p.min_child_weight and hr >= p.min_child_weight:
                gain = gl**2 / (hl + p.l2) + gr**2 / (hr + p.l2) - g.sum() ** 2 / (h.sum() + p.l2)
                if gain > best[0] + 1e-9:
                    best = (gain, f, cut)
    if best[1] is None:
        return leaf
    left = x[best[1]] <= best[2]
    sides = [grown(x[:, s], g[s], h[s], depth - 1, p) for s in (left, ~left)]
    return (best[1], best[2], *sides)


def walk(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def plain_fit(x, y, late_x, late_y, p):
    """Margins of the late rows after each round, and the areas, by plain loops."""
    weight = (y == 0).sum() / (y == 1).sum()
    margin, late, areas, margins = np.zeros(len(y)), np.zeros(len(late_y)), [], []
    for _ in range(p.rounds):
        chance = 1 / (1 + np.exp(-margin))
        w = np.where(y == 1, weight, 1.0)
        tree = grown(x, (chance - y) * w, chance * (1 - chance) * w, p.max_depth, p)
        margin += [walk(tree, row) for row in x.T]
        late = late + [walk(tree, row) for row in late_x.T]
        margins.append(late)
        shown = np.rint((late + 16) * 1024)
        area = found = 0
        for step in sorted(set(shown), reverse=True):
            some = shown >= step
            area += (late_y[some].sum() - found) / late_y.sum() * late_y[some].mean()
            found = late_y[some].sum()
        areas.append(area)
    return margins, areas


def test_equals_plain_version_and_stops(spark):
    rows, x, y = table(spark, 1, 500)
    late, late_x, late_y = table(spark, 2, 200)
    margins, areas = plain_fit(x, y, late_x, late_y, PARAMS)
    model, got = boosting.fit(rows, late, INPUTS, PARAMS)
    assert got == pytest.approx(areas[: len(got)], abs=1e-9)
    best = boosting._best_round(areas, PARAMS.patience)
    assert model.rounds == best and len(got) <= -(-(best + PARAMS.patience) // 10) * 10
    assert model.margins(late_x) == pytest.approx(margins[best - 1], abs=1e-6)
    whole, none = boosting.fit(rows, None, INPUTS, PARAMS)
    assert (whole.rounds, none) == (PARAMS.rounds, [])


def test_layout_tasks_and_renewals_change_nothing(spark, monkeypatch):
    rows, _, _ = table(spark, 3, 400)
    late, _, _ = table(spark, 4, 150)
    first, areas = boosting.fit(rows, late, INPUTS, PARAMS)
    monkeypatch.setattr(boosting, "BLOCK", 50)
    monkeypatch.setattr(boosting, "RENEWALS", 1)
    many = boosting.BoostParams(**{**PARAMS.__dict__, "rows_per_task": 90})
    second, again = boosting.fit(rows.orderBy(F.rand(3)).repartition(5), late.repartition(4), INPUTS, many)
    assert areas == again and all((getattr(first, c) == getattr(second, c)).all() for c in ("feature", "cut", "value"))


def test_rows_of_few_tasks_use_all_cores_and_one_stage_a_level(spark, monkeypatch):
    rows, _, _ = table(spark, 6, 400)
    context, inner, seen = spark.sparkContext, boosting._tree, []

    def counted(data, *rest):
        seen.append(data.getNumPartitions())
        context.setJobGroup(f"round-{len(seen)}", "a round")
        tree = inner(data, *rest)
        jobs = context.statusTracker().getJobIdsForGroup(f"round-{len(seen)}")
        stages = [len(context.statusTracker().getJobInfo(j).stageIds) for j in jobs]
        assert stages == [1] * len(jobs) and 1 <= len(jobs) <= PARAMS.max_depth
        return tree

    monkeypatch.setattr(boosting, "BLOCK", 50)
    monkeypatch.setattr(boosting, "_tree", counted)
    boosting.fit(rows, None, INPUTS, boosting.BoostParams(rounds=3, max_depth=3))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert seen == [min(8, context.defaultParallelism)] * 3


def test_patience_counts_from_the_best_round():
    assert boosting._best_round([0.1, 0.3, 0.2, 0.2, 0.9], 2) == 2
    assert boosting._best_round([0.1, 0.3, 0.2, 0.4], 2) == 4
    assert boosting._best_round([0.5, 0.5, 0.5], 9) == 1


def test_many_values_share_bins(spark):
    rows = spark.range(5_000).select(F.col("id").cast("double").alias("a"), F.lit(1.0).alias("b"), F.lit(None).cast("double").alias("c"))
    cuts = boosting.bin_cuts(rows, INPUTS, 16, 5_000)
    assert [len(c) for c in cuts] == [15, 0, 0]
    assert np.diff(cuts[0]).max() < 1.1 * 5_000 / 16


def test_one_pass_equals_walking_row_by_row(spark):
    r = np.random.default_rng(5)
    feature = r.integers(-1, 3, (30, 15))
    feature[:, 7:] = -1
    trees = forest.Forest(tuple(INPUTS), feature, r.normal(size=(30, 15)).round(1), r.normal(size=(30, 15)))
    x = r.normal(size=(3, 200)).round(1)

    def plain(row, tree):
        place = 0
        while trees.feature[tree, place] >= 0:
            place = 2 * place + 1 + (row[trees.feature[tree, place]] > trees.cut[tree, place])
        return trees.value[tree, place]

    values = np.array([[plain(row, t) for row in x.T] for t in range(30)])
    assert np.allclose(trees.margins(x), values.sum(axis=0))
    assert np.allclose(trees.prefix_margins(x), np.cumsum(values, axis=0))
    assert np.allclose(trees.first(7).margins(x), values[:7].sum(axis=0))


def test_scores_keep_all_columns(spark, tmp_path):
    trees = forest.Forest(("a", "b"), np.array([[1, -1, -1]]), np.array([[0.0, 0, 0]]), np.array([[0, -1.0, 1.0]]))
    trees.save(spark, f"{tmp_path}/m")
    loaded = forest.Forest.load(spark, f"{tmp_path}/m")
    assert loaded.inputs == trees.inputs and (loaded.value == trees.value).all()
    rows = spark.createDataFrame([(1, 2, None, "x"), (2, 0, 5.0, None), (3, 1, float("nan"), "y")], "a int, `_input_0` int, b double, _row string")
    out = forest.score(rows, loaded, "_input_0")
    assert out.columns == ["a", "b", "_row", "_input_0"]
    found = {r["a"]: r for r in out.collect()}
    assert [found[i]["_row"] for i in (1, 2, 3)] == ["x", None, "y"]
    assert [found[i]["_input_0"] for i in (1, 2, 3)] == pytest.approx([1 / (1 + np.e), np.e / (1 + np.e), 1 / (1 + np.e)])
    empty = forest.Forest(("a",), np.empty((0, 3), int), np.empty((0, 3)), np.empty((0, 3)))
    empty.save(spark, f"{tmp_path}/e")
    assert forest.Forest.load(spark, f"{tmp_path}/e").rounds == 0
    assert forest.score(rows.limit(0), loaded).count() == 0


def test_null_inputs_are_zero():
    batch = pa.record_batch({"a": pa.array([None, float("nan"), 2], pa.float64())})
    assert forest.matrix(batch, ["a"]).tolist() == [[0.0, 0.0, 2.0]]
