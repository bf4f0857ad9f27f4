"""Connected components of links between numbers, by smallest label and short cuts.

Every round each node takes the smallest label among its own and its neighbours', then
the label of its label. Labels only fall, and chains halve, so rounds grow with the
logarithm of a component's width. Each round is written to the work folder; only the
count of changed labels reaches the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.store import stored
from holdfast.operators.joins import lookup


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``label`` (smallest node reachable) of every node in ``links`` (``a``, ``b``)."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = stored(both.distinct(), "links")
    labels = stored(
        both.groupBy(F.col("a").alias("node")).agg(F.least(F.col("node"), F.min("b")).alias("label")), "labels"
    )
    while True:
        seen = lookup(both, labels.select(F.col("node").alias("b"), "label"), ["b"])
        lower = seen.groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        own = labels.join(lower, "node")
        taken = own.select("node", F.col("label").alias("old"), F.least("label", "near").alias("label"))
        target = labels.select(F.col("node").alias("label"), F.col("label").alias("next"))
        jumped = lookup(taken, target, ["label"]).select("node", "old", F.least("label", "next").alias("label"))
        jumped = stored(jumped, "labels")
        labels = jumped.select("node", "label")
        if jumped.filter("label <> old").limit(1).count() == 0:
            return labels
