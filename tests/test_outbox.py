import json
import re
from datetime import date
from random import Random

import pytest
from pyspark.sql import functions as F

from holdfast.functions.payloads import card_body, escape_html, html_body, intro_html
from holdfast.plans.outbox import delivery_list, outbox, poster_paths, with_items, with_posters

DAY = date(2024, 1, 30)
MESSAGES = (
    "event_date date, user_id long, strategy_code string, push_title string, push_body string, "
    "email_title string, email_intro string, "
    "rec_list array<struct<title: string, description: string>>, skipped boolean"
)
USERS = "user_id long, age int, gender string, plan string, churn_date date, user_email string"
POSTERS = "title string, media_type string, poster_path string"


def message(user, recs=(), code="Save", skipped=False, day=DAY):
    return (day, user, code, f"push {user}", "one\ntwo", "mail <1>", "hi **you**\n\nbye", list(recs), skipped)


@pytest.fixture
def users(spark):
    rows = [(1, 20, "F", "basic", None, "b@x"), (1, 20, "F", "basic", None, "a@x"), (2, 30, "M", "basic", None, None)]
    return spark.createDataFrame(rows, USERS)


@pytest.fixture
def posters(spark):
    rows = [
        ("a b", "tv", "/tv.jpg"),
        ("a b", "movie", "/m2.jpg"),
        ("a b", "movie", "/m1.jpg"),
        ("c", "tv", "/c.jpg"),
        ("d", "movie", None),
    ]
    return spark.createDataFrame(rows, POSTERS)


def test_delivery_list(spark, users):
    messages = spark.createDataFrame(
        [
            message(1),
            message(2),
            message(3),
            message(4, code="Calm"),
            message(5, code=None),
            message(6, skipped=True),
            message(1, day=date(2024, 1, 29)),
        ],
        MESSAGES,
    )
    rows = delivery_list(messages, users, DAY).orderBy("user_id").collect()
    assert [(r.user_id, r.age, r.user_email) for r in rows] == [
        (1, 20, "a@x"),
        (2, 30, None),
        (3, None, None),
    ]


def test_poster_choice(spark, posters):
    assert {r.title: r.poster_path for r in poster_paths(posters).collect()} == {
        "a b": "/m1.jpg",
        "c": "/c.jpg",
        "d": None,
    }
    titles = spark.createDataFrame([("a b",), ("x y z",), (None,)], "title string")
    found = {r.title: r.poster for r in with_posters(titles, posters).collect()}
    assert found["a b"] == "https://example.com/posters/m1.jpg"
    assert found["x y z"].endswith("title=x+y+z")
    assert found[None].endswith("title=")
    other = with_posters(titles, posters, base="https://p.example", placeholder="none/").collect()
    assert {r.poster for r in other} == {"https://p.example/m1.jpg", "none/x+y+z", "none/"}


def test_items_keep_order_and_repeats(spark, users, posters):
    recs = [("c", "1"), ("x", None), ("c", "2"), ("a b", "3")]
    messages = spark.createDataFrame([message(1, recs), message(2, recs), message(3)], MESSAGES)
    rows = with_items(delivery_list(messages, users, DAY), posters).collect()
    items = {r.user_id: [(i.title, i.description) for i in r["items"]] for r in rows}
    assert items == {1: recs, 2: recs, 3: []}


def test_outbox_rows_and_payloads(spark, users, posters):
    recs = [("a b", 'x "y" & z'), ("c", None)]
    messages = spark.createDataFrame([message(1, recs), message(1, recs), message(2)], MESSAGES)
    rows = outbox(delivery_list(messages, users, DAY), posters, brand="B & C", url="https://s.example/").collect()
    sent = sorted((r.user_id, r.channel, r.subject, r.recipient) for r in rows)
    assert sent == [(1, "card", "push 1", None)] * 2 + [(1, "email", "mail <1>", "a@x")] * 2 + [
        (2, "card", "push 2", None)
    ]
    mail = json.loads(next(r.payload for r in rows if r.channel == "email"))
    assert mail["senderAddress"] == "no-reply@example.com"
    assert mail["recipients"] == {"to": [{"address": "a@x"}]}
    assert mail["content"]["subject"] == "mail <1>"
    html = mail["content"]["html"]
    assert "mail &lt;1&gt;" in html and "B &amp; C" in html and 'href="https://s.example/"' in html
    assert "<p>hi <strong>you</strong></p>\n<p>bye</p>" in html
    assert "x &quot;y&quot; &amp; z" in html
    card = json.loads(next(r.payload for r in rows if r.channel == "card"))
    content = card["attachments"][0]["content"]
    assert card["type"] == "message" and content["type"] == "AdaptiveCard" and content["version"] == "1.2"
    assert content["body"][0] == {
        "type": "TextBlock",
        "size": "Medium",
        "weight": "Bolder",
        "style": "heading",
        "text": "push 1",
    }
    assert content["body"][1] == {"type": "TextBlock", "text": "one\n\ntwo", "wrap": True}
    assert content["actions"][0]["url"] == "https://s.example/"


def test_trial_run_is_limited(spark, users, posters):
    messages = spark.createDataFrame([message(2), message(1)], MESSAGES)
    rows = outbox(delivery_list(messages, users, DAY), posters, limit=1).collect()
    assert {r.user_id for r in rows} == {1} and len(rows) == 2


@pytest.mark.parametrize(("count", "rows"), [(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (6, 3)])
def test_page_has_one_large_item_and_rows_of_two(spark, count, rows):
    items = [(f"t{n}", f"d{n}", f"p{n}") for n in range(count)]
    df = spark.createDataFrame(
        [(items,)], "items array<struct<title: string, description: string, poster: string>>"
    )
    page = df.select(html_body(F.lit("T"), F.lit("I"), F.col("items"))).first()[0]
    assert re.findall(r'<img src="(\w+)"', page) == [p for _, _, p in items]
    assert page.count("display:flex") == rows
    assert page.count('class="tile"') == max(count - 1, 0)
    for tag in ("div", "html", "body", "h1", "h2", "h3", "p", "a"):
        assert len(re.findall(rf"<{tag}[ >]", page)) == page.count(f"</{tag}>")


def test_small_texts(spark):
    row = spark.range(1).select(
        escape_html(F.lit("<a & \"b\">")),
        escape_html(F.lit(None).cast("string")),
        intro_html(F.lit("*a* <b>\nc")),
        card_body(F.lit("a\nb\n\nc")),
    ).first()
    assert tuple(row) == (
        "&lt;a &amp; &quot;b&quot;&gt;",
        "",
        "<p><em>a</em> &lt;b&gt;\nc</p>",
        "a\n\nb\n\n\n\nc",
    )


def test_intro_marks(spark):
    texts = {
        "a * b * c": "<p>a * b * c</p>",
        "- a\n- **b**": "<ul><li>a</li><li><strong>b</strong></li></ul>",
        "Look:\n1. x\n2. y\n\nend": "<p>Look:</p>\n<ol><li>x</li><li>y</li></ol>\n<p>end</p>",
        "# Title\ntext": "<h1>Title</h1>\n<p>text</p>",
        "[x](https://e.example/?a=1&b)": '<p><a href="https://e.example/?a=1&amp;b">x</a></p>',
        "[x](javascript:1)": "<p>[x](javascript:1)</p>",
        "use `a*b`, __so__ and _em_ not a_b_c": "<p>use <code>a*b</code>, <strong>so</strong> and <em>em</em> not a_b_c</p>",
        "one  \ntwo\\\nthree": "<p>one<br>\ntwo<br>\nthree</p>",
        "": "",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    rows = df.select("n", intro_html(F.col("t")).alias("h")).orderBy("n").collect()
    assert [r.h for r in rows] == list(texts.values())


def test_intro_blocks_nest(spark):
    texts = {
        "- a\n  - b\n  - c\n- d": "<ul><li>a<ul><li>b</li><li>c</li></ul></li><li>d</li></ul>",
        "- a\n  1. b\n    - c\n\nend": "<ul><li>a<ol><li>b<ul><li>c</li></ul></li></ol></li></ul>\n<p>end</p>",
        "- a\n1. b": "<ul><li>a</li></ul>\n<ol><li>b</li></ol>",
        "- a\nb\n\n- c": "<ul><li>a\nb</li><li>c</li></ul>",
        "- a\n\n  b": "<ul><li>a<p>b</p></li></ul>",
        "> a\nb\n> > c\n\nd": "<blockquote><p>a\nb</p>\n<blockquote><p>c</p></blockquote></blockquote>\n<p>d</p>",
        "> - x\n> - y": "<blockquote><ul><li>x</li><li>y</li></ul></blockquote>",
        "t\n```py\n*a* <b>\n\n- c\n```\n*e*": "<p>t</p>\n<pre><code>*a* &lt;b&gt;\n\n- c\n</code></pre>\n<p><em>e</em></p>",
        "~~~\nopen": "<pre><code>open\n</code></pre>",
        "a\n***\n## b\n- - -": "<p>a</p>\n<hr>\n<h2>b</h2>\n<hr>",
    }
    df = spark.createDataFrame(list(enumerate(texts)), "n int, t string")
    rows = df.select("n", intro_html(F.col("t")).alias("h")).orderBy("n").collect()
    assert [r.h for r in rows] == list(texts.values())


def test_intro_tags_are_balanced(spark):
    random = Random(5)
    pieces = ["> ", "- ", "1. ", "  ", "    ", "```", "a", "**b**", "# ", "---", "<", "\n", "\n", "\n\n", "`c`", "\t", "~~~", ">"]
    texts = ["".join(random.choices(pieces, k=random.randint(1, 30))) for _ in range(400)]
    found = spark.createDataFrame([(t,) for t in texts], "t string").select("t", intro_html(F.col("t")).alias("h")).collect()
    assert len(found) == 400
    for row in found:
        opened = []
        for end, tag in re.findall(r"<(/?)([a-z0-9]+)[^>]*>", row.h):
            if end:
                assert opened and opened.pop() == tag, row
            elif tag not in ("br", "hr"):
                opened.append(tag)
        assert not opened, row
