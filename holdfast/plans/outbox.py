"""Delivery rows: messages with their users, and one payload per channel."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.payloads import (
    BRAND,
    POSTER_BASE,
    POSTER_PLACEHOLDER,
    SENDER,
    SITE_URL,
    card_payload,
    email_payload,
    html_body,
    poster_url,
)
from holdfast.operators.titles import closest_posters
from holdfast.operators.joins import lookup
from holdfast.sources.tables import day_literal

USER_COLUMNS = ["age", "gender", "plan", "churn_date", "user_email"]


def delivery_list(messages: DataFrame, users: DataFrame, day: date | str) -> DataFrame:
    """Messages of one date that may go out, with the user's attributes.

    ``messages`` is the stored message table. The user table is reduced to users with a
    message before it is made unique, by the same key.
    """
    to_send = messages.filter(
        (F.col("event_date") == day_literal(day))
        & (F.col("strategy_code") != "Calm")
        & ~F.col("skipped")
    )
    attributes = (
        users.select("user_id", *USER_COLUMNS)
        .join(to_send.select("user_id").distinct(), "user_id", "left_semi")
        .groupBy("user_id")
        .agg(F.min(F.struct(*USER_COLUMNS)).alias("_user"))
        .select("user_id", "_user.*")
    )
    return lookup(to_send, attributes, ["user_id"]).select(*messages.columns, *USER_COLUMNS)


def poster_paths(posters: DataFrame) -> DataFrame:
    """One path per title: a movie's if there is one, else a series'."""
    path = F.col("poster_path")
    return posters.groupBy("title").agg(
        F.coalesce(
            F.min(F.when(F.col("media_type") == "movie", path)),
            F.min(F.when(F.col("media_type") == "tv", path)),
        ).alias("poster_path")
    )


def with_posters(
    titled: DataFrame,
    posters: DataFrame,
    base: str = POSTER_BASE,
    placeholder: str = POSTER_PLACEHOLDER,
    inexact: bool = False,
) -> DataFrame:
    """Add ``poster`` to rows with a ``title``.

    ``inexact`` takes the closest title within a few edits (see :mod:`holdfast.operators.titles`),
    else titles have to be equal.
    """
    paths = closest_posters(titled, posters).drop("edits") if inexact else poster_paths(posters)
    return (
        lookup(titled, paths, ["title"])
        .withColumn("poster", poster_url(F.col("poster_path"), F.col("title"), base, placeholder))
        .select(*titled.columns, "poster")
    )


def with_items(
    delivery: DataFrame,
    posters: DataFrame,
    base: str = POSTER_BASE,
    placeholder: str = POSTER_PLACEHOLDER,
) -> DataFrame:
    """Add ``items``: the recommendations with their posters, in order.

    Only titles and their places are shuffled, never the texts: posters are found for
    distinct titles and come back to a message by date, user and hash of its titles.
    """
    key = ["event_date", "user_id", "_titles"]
    keyed = delivery.withColumn("_titles", F.xxhash64("rec_list.title"))
    entries = keyed.select(*key, F.posexplode("rec_list.title").alias("pos", "title")).distinct()
    found = with_posters(entries.select("title").distinct(), posters, base, placeholder)
    by_list = (
        lookup(entries, found.filter("title is not null"), ["title"])
        .groupBy(*key)
        .agg(F.array_sort(F.collect_list(F.struct("pos", "poster"))).alias("_posters"))
    )
    blank = poster_url(F.lit(None).cast("string"), F.lit(None).cast("string"), base, placeholder)
    items = F.transform(
        "rec_list",
        lambda rec, i: F.struct(
            i.alias("pos"),
            rec["title"].alias("title"),
            rec["description"].alias("description"),
            F.coalesce(F.get(F.col("_posters.poster"), i), blank).alias("poster"),
        ),
    )
    none = F.array().cast("array<struct<pos: int, title: string, description: string, poster: string>>")
    joined = lookup(keyed, by_list, key).withColumn("items", F.coalesce(items, none))
    return joined.select(*delivery.columns, "items")


def outbox(
    delivery: DataFrame,
    posters: DataFrame,
    brand: str = BRAND,
    url: str = SITE_URL,
    sender: str = SENDER,
    limit: int | None = None,
    poster_base: str = POSTER_BASE,
    poster_placeholder: str = POSTER_PLACEHOLDER,
) -> DataFrame:
    """One row per message and channel; no e-mail row without an address.

    ``limit`` sends only that many messages, for a trial run.
    """
    if limit is not None:
        delivery = delivery.orderBy("user_id").limit(limit)
    html = html_body(F.col("email_title"), F.col("email_intro"), F.col("items"), brand, url)
    mail = F.struct(
        F.lit("email").alias("channel"),
        F.col("email_title").alias("subject"),
        F.col("user_email").alias("recipient"),
        email_payload(F.col("email_title"), html, F.col("user_email"), sender).alias("payload"),
    )
    card = F.struct(
        F.lit("card").alias("channel"),
        F.col("push_title").alias("subject"),
        F.lit(None).cast("string").alias("recipient"),
        card_payload(F.col("push_title"), F.col("push_body"), url).alias("payload"),
    )
    channels = F.when(F.col("user_email").isNull(), F.array(card)).otherwise(F.array(mail, card))
    itemised = with_items(delivery, posters, poster_base, poster_placeholder)
    return itemised.select("event_date", "user_id", F.inline(channels))
