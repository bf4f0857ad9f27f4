"""Reading what the text generator returned: guard, playbook, copy."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions import wording

COPY_SCHEMA = (
    "push_title string, push_body string, email_title string, email_intro string, "
    "rec_list array<struct<title: string, description: string>>"
)
_RAW_SCHEMA = COPY_SCHEMA.replace("array<struct<title: string, description: string>>", "array<variant>")
COPY_FIELDS = ["push_title", "push_body", "email_title", "email_intro", "rec_list"]

# White space as Python's str.strip sees it.
_SPACE = r"[\s\x{1c}-\x{1f}]"
_NOT_BLANK = r"(?U)[^\s\x{1c}-\x{1f}]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with the value computed once however often it is used.

    Conditions are not shared between the branches of a ``when``, so without this
    a response would be parsed again for every key that is looked at.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def guard_response(answered: Column, content: Column, refusal: Column) -> Column:
    """The text of a response, or a marked text when there is none to use."""
    return (
        F.when(~F.coalesce(answered, F.lit(False)), wording.NO_RESPONSE)
        .when(refusal != "", F.concat(F.lit(wording.REFUSED), refusal))
        .when(~F.coalesce(content.rlike(_NOT_BLANK), F.lit(False)), wording.BLANK_RESPONSE)
        .otherwise(content)
    )


def strict_json(text: Column) -> Column:
    """A variant holding the one JSON value of ``text`` at ``$[0]``, else null.

    Spark's parser stops after the first value and ignores what follows. Inside
    brackets trailing text breaks the array, and a second value becomes an
    element that can be tested for.
    """
    wrapped = F.try_parse_json(F.concat(F.lit("["), text, F.lit("]")))
    return let(
        wrapped, lambda v: F.when(F.try_variant_get(v, "$[1]", "variant").isNull(), v)
    )


def playbook_valid(value: Column) -> Column:
    """Whether every playbook key of the variant's ``$[0]`` is a non-blank string."""
    return let(value, _has_all_keys)


def _has_all_keys(value: Column) -> Column:
    valid = F.lit(True)
    for key in wording.PLAYBOOK_KEYS:
        path = f"$[0].{key}"
        kind = F.schema_of_variant(F.try_variant_get(value, path, "variant"))
        filled = F.try_variant_get(value, path, "string").rlike(_NOT_BLANK)
        valid = valid & F.coalesce((kind == "STRING") & filled, F.lit(False))
    return valid


def json_block(raw: Column) -> Column:
    """From the first opening to the last closing brace; empty when there is none."""
    return F.regexp_extract(raw, r"(?s)\{.*\}", 0)


def extract_playbook(raw: Column) -> Column:
    """The valid playbook in a response as JSON text, else null.

    The block from first to last brace is the whole text when that is an object,
    so both cases are one. Keys keep their order, extra keys included.
    """
    return let(json_block(raw), lambda b: F.when(playbook_valid(strict_json(b)), _rewritten(b)))


def _rewritten(block: Column) -> Column:
    """The object's keys in the order they first come in, each with its last value."""
    pairs = F.map_entries(F.from_json(block, "map<string, variant>"))
    return let(pairs, _last_values)


def _last_values(pairs: Column) -> Column:
    def text(key: Column) -> Column:
        last = F.element_at(F.filter(pairs, lambda pair: pair["key"] == key), -1)
        return F.concat(_quoted(key), F.lit(": "), F.to_json(last["value"]))

    return _object_text(F.transform(F.array_distinct(F.transform(pairs, lambda pair: pair["key"])), text))


def playbook_fallback() -> Column:
    """A playbook from the first entries of the guide, as JSON text."""
    values = {
        "hook": F.lit(wording.FALLBACK_HOOK),
        "angle": _first("angles", wording.FALLBACK_ANGLE),
        "content_direction": F.lit(wording.FALLBACK_DIRECTION),
        "cta": _first("cta_candidates", wording.FALLBACK_CTA),
        "tone": _first("tone_candidates", wording.FALLBACK_TONE),
        "urgency_level": _first("urgency_candidates", wording.FALLBACK_URGENCY),
    }
    pairs = [F.concat(F.lit(f'"{key}": '), _quoted(value)) for key, value in values.items()]
    return _object_text(F.array(*pairs))


def parse_copy(raw: Column) -> Column:
    """The five copy fields of a response as a struct; all null if it is no object."""
    bare = strip(F.replace(F.replace(strip(raw), F.lit("```json")), F.lit("```")))
    read = F.from_json(let(bare, lambda text: F.when(_is_object(text), text)), _RAW_SCHEMA)
    return let(read, lambda r: F.when(r.isNotNull(), _copy_of(r)))


def _copy_of(read: Column) -> Column:
    """Elements of the list that are no objects with a title or description are left out."""
    entries = F.transform(
        read["rec_list"],
        lambda e: F.struct(
            *(F.try_variant_get(e, f"$.{name}", "string").alias(name) for name in ("title", "description"))
        ),
    )
    known = F.filter(entries, lambda e: e["title"].isNotNull() | e["description"].isNotNull())
    return F.struct(*(read[name].alias(name) for name in COPY_FIELDS[:-1]), known.alias("rec_list"))


def _is_object(text: Column) -> Column:
    value = F.try_variant_get(strict_json(text), "$[0]", "variant")
    return F.schema_of_variant(value).startswith("OBJECT")


def copy_defaults(df: DataFrame) -> DataFrame:
    """Default copy for fields that are null or empty; blank text is kept."""
    defaults = {
        "push_title": wording.DEFAULT_TITLE,
        "push_body": wording.DEFAULT_BODY,
        "email_title": wording.DEFAULT_TITLE,
        "email_intro": wording.DEFAULT_BODY,
    }
    filled = {name: _unless_empty(name, text) for name, text in defaults.items()}
    empty = F.array().cast("array<struct<title: string, description: string>>")
    return df.withColumns({**filled, "rec_list": F.coalesce("rec_list", empty)})


def _unless_empty(name: str, text: str) -> Column:
    return F.when(F.col(name) != "", F.col(name)).otherwise(text)


def _first(name: str, default: str) -> Column:
    return F.coalesce(F.get(F.col(name), F.lit(0)), F.lit(default))


def _quoted(text: Column) -> Column:
    return let(F.to_json(F.array(text)), lambda t: t.substr(F.lit(2), F.length(t) - 2))


def _object_text(pairs: Column) -> Column:
    return F.concat(F.lit("{"), F.array_join(pairs, ", "), F.lit("}"))
