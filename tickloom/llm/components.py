"""Connected components of a links table, by hooking to smaller labels and shortening paths."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import by_size, stored


def labels(links: DataFrame) -> DataFrame:
    """node, label (the smallest node reachable) for each node of ``links`` (a, b).

    Rounds: each node takes the least label among itself and its neighbours, then its label's label.
    Labels fall to the minimum in a number of rounds about the logarithm of the longest path. Each round is stored
    in the shared folder, so that neither lineage nor lost executors add up. A node that
    many links share is combined before each shuffle. Null ends and links of a node to itself are left out.
    """
    real = links.filter(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b"))).select("a", "b")
    both = stored(real.union(real.select("b", "a")).distinct(), "links")
    now = stored(both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("label")), "labels")
    while True:
        small = by_size(now)
        near = both.join(small.select(F.col("node").alias("b"), "label"), "b").groupBy(F.col("a").alias("node")).agg(F.min("label").alias("near"))
        hooked = near.join(small, "node").select("node", F.least("label", "near").alias("hook"), F.col("label").alias("was"))
        up = small.select(F.col("node").alias("hook"), F.col("label").alias("up"))
        after = stored(hooked.join(up, "hook").select("node", F.least("hook", "up").alias("label"), "was"), "labels")
        changed = after.filter("label <> was").limit(1).count()
        now = after.select("node", "label")
        if not changed:
            return now


def merged(known: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels after more links: only the links between known components are walked."""
    if known is None:
        return labels(links)
    small = by_size(known)
    on = lambda side: small.select(F.col("node").alias(side), F.col("label").alias(f"l{side}"))
    short = links.join(on("a"), "a", "left").join(on("b"), "b", "left").select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b"))
    fresh = labels(short)
    moved = by_size(fresh).select(F.col("node").alias("label"), F.col("label").alias("to"))
    old = known.join(moved, "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return stored(old.union(fresh.join(small, "node", "left_anti")), "labels")
