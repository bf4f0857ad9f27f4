import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from holdfast.llm import divergence

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id bigint, text string, lang string, source string"


def brute(rows, least, top):
    """(lang, source, part, item, value, rank) by plain Python."""
    rows = [tuple(x or "" for x in row) for row in rows]
    held, count = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = TERM.findall(text.translate(LOWER))
        held[lang].update(set(terms))
        count[lang, source].update(terms)
    found = []
    for lang in {r[1] for r in rows}:
        kept = [t for t, n in held[lang].items() if n >= least]
        sources = sorted({r[2] for r in rows if r[1] == lang}, key=str.encode)

        def share(n, kept=kept):
            total = sum(n[t] for t in kept)
            return {t: 1 + 10**9 * (n[t] + 2) // (total + 2 * len(kept)) for t in kept}

        q = share(sum((count[lang, s] for s in sources), Counter()))
        p = {s: share(count[lang, s]) for s in sources}
        value = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = [(sum(value(p[s][t], p[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(value(p[s][t], q[t]), t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                items.sort(key=lambda x: (-x[0], x[1].encode()))
                for rank, (v, item) in enumerate(items if part == "pair" else items[:top], 1):
                    found.append((lang, s, part, item, v, rank))
    return sorted(found)


def table(spark, rows):
    return spark.createDataFrame([(i, *row) for i, row in enumerate(rows)], DOCS)


def prose(seed, count, langs, sources, skew=True):
    r = random.Random(seed)
    vocabulary = [f"{a}{b}" for a in ["Alpha", "beta", "über", "日本", "x", "É", "zz"] for b in ["", "q", "ß", "Q"]]
    weights = {s: [r.random() ** 4 for _ in vocabulary] for s in sources}
    rows = []
    for _ in range(count):
        s = sources[0] if skew and r.random() < 0.4 else r.choice(sources)
        words = r.choices(vocabulary, weights[s], k=r.randrange(0, 40))
        rows.append((r.choice([" ", "1", "\n", "_"]).join(words), r.choice(langs), s))
    return rows


def got(frame):
    return sorted(map(tuple, frame.collect()))


@pytest.mark.parametrize("least, top", [(1, 10), (10, 3), (10_000, 10)])
def test_against_plain_version(spark, least, top):
    rows = prose(least, 300, ["en", "de", None], ["a", "ä", "", None, "é", "z", "Z"])
    rows += [(None, "en", "a"), ("", "xx", "only"), ("alone " * 20, "yy", None), ("beta " * 40_000, "en", "z")]
    assert got(divergence.audit_sources(table(spark, rows), least, top)) == brute(rows, least, top)


def test_more_sources_than_a_block_and_many_shards(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SOURCES", 4)
    monkeypatch.setattr(divergence, "SHARD_TERMS", 3)
    monkeypatch.setattr(divergence, "MERGE_ROWS", 20)
    monkeypatch.setattr(divergence, "_HELD_BYTES", 2_000)
    rows = prose(5, 400, ["en", "de"], [f"s{i}" for i in range(11)])
    assert got(divergence.audit_sources(table(spark, rows).repartition(4), 3)) == brute(rows, 3, 10)


@pytest.mark.parametrize("seed", range(6))
def test_skybands_hold_the_first_whatever_the_totals(seed):
    r = np.random.default_rng(seed)
    size = int(r.integers(1, 3_000))
    n = r.integers(1, [4, 50, 10_000][seed % 3], size)
    lang_n = n + r.integers(0, [3, 40, 10_000][seed % 3], size)
    term = r.permutation(size)
    band = set(divergence.skyband(n, lang_n, term, 5).tolist())
    dominated = [
        ((n >= n[i]) & (lang_n <= lang_n[i]) & (term <= term[i])).sum() - 1 for i in range(size)
    ]
    assert band == {i for i, d in enumerate(dominated) if d < 5}
    for own, whole in ((n.sum(), lang_n.sum()), (n.sum() * 2, lang_n.sum() * 9), (10**6, 10**6 + 1)):
        p, q = 1 + 10**9 * (n + 2) // (own + 2 * size), 1 + 10**9 * (lang_n + 2) // (whole + 2 * size)
        above = [i for i in range(size) if p[i] > q[i]]
        above.sort(key=lambda i: (-((p[i] - q[i]) ** 2 // (p[i] + q[i])), term[i]))
        assert set(above[:5]) <= band


def test_bands_of_bands(spark):
    rows = prose(8, 500, ["en"], ["a", "b"], skew=False)
    cells = divergence.term_cells(table(spark, rows).select("lang", "source", "text"), 1)
    whole = divergence._bands(cells.select("lang", "source", "term", "n", "lang_n").toArrow(), 2)
    parts = [divergence._bands(whole.slice(i, 7), 2) for i in range(0, whole.num_rows, 7)]
    key = lambda t: sorted(map(tuple, (r.values() for r in t.to_pylist())))
    import pyarrow as pa

    assert key(divergence._bands(pa.concat_tables(parts), 2)) == key(whole)


def test_parts_of_long_texts(monkeypatch):
    monkeypatch.setattr(divergence, "_PART", 5)
    text = "Ab1cd  Éf longterm_x " * 9
    found = [t.decode() for part in divergence._term_parts(text.encode()) for t in part]
    assert found == TERM.findall(text.translate(LOWER))


def test_repeats_empty_tables_and_clashing_names(spark):
    rows = prose(4, 40, ["en"], ["a", "b", "c"]) * 3
    named = table(spark, rows).withColumnsRenamed({"doc_id": "total"}).selectExpr("*", "1 as kept", "2 as term", "3 as n")
    assert got(divergence.audit_sources(named, 5)) == brute(rows, 5, 10)
    assert divergence.audit_sources(table(spark, [])).count() == 0
