"""Bodies and payloads of the delivery channels."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from holdfast.functions import wording
from holdfast.functions.text import fill

BRAND = "Streaming"
SITE_URL = "https://example.com/"
SENDER = "no-reply@example.com"

POSTER_BASE = "https://example.com/posters"
POSTER_PLACEHOLDER = "https://example.com/posters/none?title="

# The page: a narrow column on a light ground; a lead story, then tiles side by side.
_PAGE_TOP = (
    '<html><body style="margin:0;background:#eef1f4;font-family:Georgia,serif;color:#22303c">'
    '<div style="max-width:36em;margin:0 auto;background:#fff">'
    '<div style="background:#24527a;color:#fff;padding:.8em 1.5em"><<brand>></div>'
    '<div style="padding:1em 1.5em"><h1 style="font-size:1.4em"><<title>></h1><<intro>></div>'
)
_FEATURED = (
    '<div style="padding:0 1.5em 1em;border-bottom:1px solid #d5dce2">'
    '<img src="<<poster>>" style="display:block;width:100%" alt="">'
    '<h2 style="font-size:1.2em"><<title>></h2><p><<description>></p></div>'
)
_PAIR = '<div style="display:flex;gap:1em;padding:1em 1.5em"><<tiles>></div>'
_TILE = (
    '<div class="tile" style="flex:1"><img src="<<poster>>" style="display:block;width:100%" alt="">'
    "<h3><<title>></h3><p><<description>></p></div>"
)
_PAGE_END = (
    '<p style="padding:1em 1.5em 2em"><a style="color:#24527a" href="<<url>>"><<action>></a></p>'
    "</div></body></html>"
)


def escape_html(text: Column) -> Column:
    """Text that is safe inside markup and attributes; null becomes empty."""
    escaped = F.coalesce(text, F.lit(""))
    for char, entity in {"&": "&amp;", "<": "&lt;", ">": "&gt;", '"': "&quot;"}.items():
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    return escaped


_QUOTED = r"^(?: {0,3}&gt; ?)*"
_RULE = r"^ {0,3}(?:(?:-[ \t]*){3,}|(?:\*[ \t]*){3,}|(?:_[ \t]*){3,})$"
_STATE = (
    "struct<out: string, quotes: int, lists: array<struct<tag: string, indent: int>>, "
    "pending: string, paragraph: boolean, code: boolean, gap: boolean>"
)


def intro_html(intro: Column) -> Column:
    """HTML of the marked up intro, in which every tag that opens closes.

    Blocks are paragraphs, headings, rules, fenced code, quotes (``>``, also nested) and lists, nested by an indent of two or
    more. Inline marks are links, code, emphasis and hard breaks; they must touch the text they
    enclose. Lines are folded over the containers that are open.
    """
    text = F.regexp_replace(escape_html(intro), r"\r\n?", "\n")
    start = F.lit("").alias("out"), F.lit(0).alias("quotes"), F.from_json(F.lit("[]"), "array<struct<tag: string, indent: int>>").alias("lists")
    none = F.lit(None).cast("string").alias("pending"), *(F.lit(False).alias(n) for n in ("paragraph", "code", "gap"))
    lines = F.transform(F.split(text, "\n"), _line)
    return F.aggregate(lines, F.struct(*start, *none).cast(_STATE), _next_state, _all_closed)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _line(line: Column) -> Column:
    """What kind of line it is, how deep, and its text."""
    prefix = F.regexp_extract(line, _QUOTED, 0)
    rest = F.regexp_replace(F.substring(line, F.length(prefix) + 1, F.length(line)), "\t", "    ")

    def parts(rest: Column) -> Column:
        kind = (
            F.when(F.trim(rest) == "", "blank")
            .when(rest.rlike(r"^ *(?:```|~~~)"), "fence")
            .when(rest.rlike(r"^#{1,6} "), "heading")
            .when(rest.rlike(_RULE), "rule")
            .when(rest.rlike(r"^ *(?:[-*+]|\d+[.)]) +"), "item")
            .otherwise("text")
        )
        return F.struct(
            line.alias("raw"),
            ((F.length(prefix) - F.length(F.replace(prefix, F.lit("&gt;")))) / 4).cast("int").alias("quotes"),
            F.length(F.regexp_extract(rest, "^ *", 0)).alias("indent"),
            kind.alias("kind"),
            F.when(rest.rlike(r"^ *\d"), "ol").otherwise("ul").alias("tag"),
            F.length(F.regexp_extract(rest, "^#*", 0)).cast("string").alias("level"),
            F.ltrim(rest).alias("text"),
        )

    return _let(rest, parts)


def _next_state(state: Column, line: Column) -> Column:
    kind, text = line["kind"], line["text"]
    lazy = (kind == "text") & state["pending"].isNotNull() & (line["quotes"] < state["quotes"])
    quotes = F.when(lazy, state["quotes"]).otherwise(line["quotes"])
    requoted = quotes != state["quotes"]
    ends_lists = requoted | ((line["indent"] == 0) & (kind.isin("heading", "rule", "fence") | ((kind == "text") & state["gap"])))
    upper = F.when(ends_lists, F.slice(state["lists"], 1, 0)).when(
        kind == "item", F.filter(state["lists"], lambda x: x["indent"] <= line["indent"])
    ).otherwise(state["lists"])

    def with_lists(upper: Column) -> Column:
        last = F.try_element_at(upper, F.lit(-1))
        sibling = (kind == "item") & F.coalesce(line["indent"] < last["indent"] + 2, F.lit(False))
        same = sibling & (last["tag"] == line["tag"])
        kept = F.when(sibling & ~same, F.slice(upper, 1, F.greatest(F.size(upper) - 1, F.lit(0)))).otherwise(upper)
        return _let(F.struct(kept.alias("kept"), same.alias("same")), with_kept)

    def with_kept(found: Column) -> Column:
        kept, same = found["kept"], found["same"]
        goes_on = (kind == "text") & state["pending"].isNotNull() & ~requoted
        opens = ~same & ~goes_on & (kind != "blank") & (F.size(kept) == 0) & (state["out"] != "")
        begins = ~goes_on & (kind != "blank")
        first = F.when(opens | (begins & (F.size(kept) == 0) & state["pending"].isNotNull() & ~same), "\n").otherwise("")
        heading = _inline(F.trim(F.regexp_replace(text, "^#+ +", "")))
        opener = (
            F.when(same, "</li><li>")
            .when(kind == "item", F.concat(F.lit("<"), line["tag"], F.lit("><li>")))
            .when(kind == "heading", F.concat(F.lit("<h"), line["level"], F.lit(">"), heading, F.lit("</h"), line["level"], F.lit(">")))
            .when(kind == "rule", "<hr>")
            .when(kind == "fence", "<pre><code>")
            .otherwise("")
        )
        out = F.concat(
            state["out"],
            F.when(goes_on, "").otherwise(_pending_html(state)),
            _list_ends(state["lists"], F.size(kept)),
            F.repeat(F.lit("</blockquote>"), F.greatest(state["quotes"] - quotes, F.lit(0))),
            first,
            F.repeat(F.lit("<blockquote>"), F.greatest(quotes - state["quotes"], F.lit(0))),
            opener,
        )
        own = F.array(F.struct(line["tag"].alias("tag"), line["indent"].alias("indent")))
        return F.struct(
            out.alias("out"),
            quotes.alias("quotes"),
            F.when((kind == "item") & ~same, F.concat(kept, own)).otherwise(kept).alias("lists"),
            F.when(goes_on, F.concat(state["pending"], F.lit("\n"), text))
            .when(kind == "item", F.regexp_replace(text, r"^(?:[-*+]|\d+[.)]) +", ""))
            .when(kind == "text", text)
            .alias("pending"),
            F.when(goes_on, state["paragraph"]).otherwise(kind == "text").alias("paragraph"),
            (kind == "fence").alias("code"),
            (kind == "blank").alias("gap"),
        ).cast(_STATE)

    closes = kind == "fence"
    in_code = F.struct(
        F.concat(state["out"], F.when(closes, "</code></pre>").otherwise(F.concat(line["raw"], F.lit("\n")))).alias("out"),
        *(state[n].alias(n) for n in ("quotes", "lists", "pending", "paragraph")),
        (~closes).alias("code"),
        F.lit(False).alias("gap"),
    ).cast(_STATE)
    return F.when(state["code"], in_code).otherwise(_let(upper, with_lists))


def _pending_html(state: Column) -> Column:
    broken = F.regexp_replace(F.trim(state["pending"]), r"(?: {2,}|\\)\n", "<br>\n")
    html = _inline(broken)
    return F.coalesce(F.when(state["paragraph"], F.concat(F.lit("<p>"), html, F.lit("</p>"))).otherwise(html), F.lit(""))


def _list_ends(lists: Column, kept: Column | int) -> Column:
    """Ends of the lists beyond the first ``kept``, innermost first."""
    ends = F.transform(lists, lambda x: F.concat(F.lit("</li></"), x["tag"], F.lit(">")))
    return F.array_join(F.reverse(F.filter(ends, lambda x, i: i >= kept)), "")


def _all_closed(state: Column) -> Column:
    return F.concat(
        state["out"],
        F.when(state["code"], "</code></pre>").otherwise(""),
        _pending_html(state),
        _list_ends(state["lists"], 0),
        F.repeat(F.lit("</blockquote>"), state["quotes"]),
    )


def _inline(text: Column) -> Column:
    """Marks within a line, applied in turn."""
    marks = [
        (r"`([^`\n]+)`", "<code>$1</code>"),
        (r"\[([^\]\n]+)\]\((https?://[^\s)]+)\)", '<a href="$2">$1</a>'),
        (r"\*\*(?=\S)(.+?)(?<=\S)\*\*", "<strong>$1</strong>"),
        (r"(?<!\w)__(?=\S)(.+?)(?<=\S)__(?!\w)", "<strong>$1</strong>"),
        (r"\*(?=[^\s*])([^*]+?)(?<=\S)\*", "<em>$1</em>"),
        (r"(?<![\w/])_(?=\S)([^_]+?)(?<=\S)_(?!\w)", "<em>$1</em>"),
    ]
    for pattern, html in marks:
        text = F.regexp_replace(text, pattern, html)
    return text


def poster_url(
    path: Column, title: Column, base: str = POSTER_BASE, placeholder: str = POSTER_PLACEHOLDER
) -> Column:
    """The poster's address, or a placeholder that shows the title."""
    missing = F.concat(
        F.lit(placeholder), F.replace(F.coalesce(title, F.lit("")), F.lit(" "), F.lit("+"))
    )
    return F.coalesce(F.concat(F.lit(base), path), missing)


def html_body(
    title: Column, intro: Column, items: Column, brand: str = BRAND, url: str = SITE_URL
) -> Column:
    """The e-mail page: header, intro, the first item large, the rest two by two.

    ``items`` is an array of structs with title, description and poster.
    """
    top = fill(
        _PAGE_TOP, brand=escape_html(F.lit(brand)), title=escape_html(title), intro=intro_html(intro)
    )
    featured = F.coalesce(_item(_FEATURED, F.get(items, F.lit(0))), F.lit(""))
    rest = F.slice(items, 2, F.greatest(F.size(items) - 1, F.lit(0)))
    pairs = F.transform(
        F.sequence(F.lit(1), F.greatest(F.ceil(F.size(rest) / 2).cast("int"), F.lit(1))),
        lambda i: fill(
            _PAIR, tiles=F.array_join(F.transform(F.slice(rest, 2 * i - 1, 2), lambda x: _item(_TILE, x)), "")
        ),
    )
    grid = F.when(F.size(rest) > 0, F.array_join(pairs, "")).otherwise("")
    end = fill(_PAGE_END, url=F.lit(url), action=F.lit(wording.EMAIL_ACTION))
    return F.concat(top, featured, grid, end)


def _item(template: str, item: Column) -> Column:
    filled = fill(
        template,
        poster=escape_html(item["poster"]),
        title=escape_html(item["title"]),
        description=escape_html(item["description"]),
    )
    return F.when(item.isNotNull(), filled)


def email_payload(subject: Column, html: Column, recipient: Column, sender: str = SENDER) -> Column:
    """The mail service's message as JSON."""
    return F.to_json(
        F.struct(
            F.lit(sender).alias("senderAddress"),
            F.struct(subject.alias("subject"), html.alias("html")).alias("content"),
            F.struct(F.array(F.struct(recipient.alias("address"))).alias("to")).alias("recipients"),
        )
    )


def card_body(body: Column) -> Column:
    """Card text: single line breaks are doubled to show as breaks."""
    return F.replace(body, F.lit("\n"), F.lit("\n\n"))


def card_payload(title: Column, body: Column, url: str = SITE_URL) -> Column:
    """An adaptive card with a heading, the text and one button, as JSON."""
    heading = {"type": "TextBlock", "size": "Medium", "weight": "Bolder", "style": "heading"}
    text = {"type": "TextBlock"}
    blocks = F.array(
        _block(heading, title, wrap=None),
        _block(text, card_body(body), wrap=True),
    )
    action = F.struct(
        F.lit("Action.OpenUrl").alias("type"),
        F.lit(wording.CARD_ACTION).alias("title"),
        F.lit(url).alias("url"),
    )
    content = F.struct(
        F.lit("http://adaptivecards.io/schemas/adaptive-card.json").alias("$schema"),
        F.lit("AdaptiveCard").alias("type"),
        F.lit("1.2").alias("version"),
        blocks.alias("body"),
        F.array(action).alias("actions"),
    )
    attachment = F.struct(
        F.lit("application/vnd.microsoft.card.adaptive").alias("contentType"),
        content.alias("content"),
    )
    return F.to_json(
        F.struct(F.lit("message").alias("type"), F.array(attachment).alias("attachments"))
    )


def _block(fixed: dict[str, str], text: Column, wrap: bool | None) -> Column:
    """A text block; to_json leaves out the fields that are null."""
    return F.struct(
        *(F.lit(fixed.get(name)).cast("string").alias(name) for name in ("type", "size", "weight", "style")),
        text.alias("text"),
        F.lit(wrap).cast("boolean").alias("wrap"),
    )
