import random

import pytest
from pyspark.sql import functions as F

from holdfast.operators import titles
from holdfast.plans.outbox import with_posters


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def edited(r, title, edits):
    for _ in range(edits):
        at = r.randrange(len(title) + 1)
        title = title[:at] + r.choice(["", "x", "é"]) + title[at + r.randrange(2) :]
    return title


@pytest.mark.parametrize("seed", range(2))
def test_against_all_pairs(spark, seed):
    r = random.Random(seed)
    names = [" ".join(r.choices(["the", "red", "bolt", "aa", "aaaa", "night", "é", "日本の", "ab"], k=r.randrange(1, 5))) for _ in range(60)]
    posters = [(n, r.choice(["movie", "tv"]), f"/{i}.jpg") for i, n in enumerate(names)]
    wanted = sorted({edited(r, r.choice(names), r.randrange(4)) for _ in range(150)} | {"", "zzzzzzzzzzzzz"})
    got = titles.closest_posters(
        spark.createDataFrame([(w,) for w in [*wanted, None]], "title string"),
        spark.createDataFrame([*posters, ("no path", "movie", None), (None, "tv", "/n.jpg"), ("a person", "person", "/p.jpg")], "title string, media_type string, poster_path string"),
    )
    expected = {}
    for w in wanted:
        plain = " ".join(w.split())
        most = 0 if len(plain) < 5 else 1 if len(plain) < 10 else 2
        found = [(distance(plain, n), k == "tv", n, p) for n, k, p in posters if distance(plain, n) <= most]
        if plain and found:
            expected[w] = (min(found)[3], min(found)[0])
    assert {row["title"]: (row["poster_path"], row["edits"]) for row in got.collect()} == expected and len(expected) > 50


def test_posters_of_inexact_titles(spark):
    posters = spark.createDataFrame([("Night Train", "tv", "/t.jpg"), ("night train", "movie", "/m.jpg")], "title string, media_type string, poster_path string")
    titled = spark.createDataFrame([(1, "Nigth Train"), (2, "Day Train"), (3, None)], "id int, title string")
    found = with_posters(titled, posters, "http://p", "none?{}", inexact=True).orderBy("id").collect()
    assert found[0]["poster"].endswith("/m.jpg") and not any("/m.jpg" in (r["poster"] or "") for r in found[1:])


def test_no_all_pairs(spark):
    frame = spark.createDataFrame([("a title", "tv", "/x")], "title string, media_type string, poster_path string")
    plan = titles.closest_posters(frame.select("title"), frame)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert titles.closest_posters(frame.select("title").limit(0), frame).count() == 0
    assert titles.closest_posters(frame.select("title"), frame.filter(F.lit(False))).count() == 0
