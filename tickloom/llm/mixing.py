"""Mixing sources to target weights by exact cuts of a random order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm.common import WORD, checkpointed

#: Documents that one bucket of the random order holds on average.
BUCKET_ROWS = 1_000
#: No source is repeated more often than this.
MOST_EPOCHS = 3


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def random_key(seed: int) -> Column:
    """Hash-random text key of a document; md5, which other engines have as well."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))))


def targets(sizes: DataFrame) -> DataFrame:
    """Targets of sources: (source, source_size) to (source, source_size, target double).

    Sources in code point order, null last, weigh 1, 2, 3, repeating. A target is
    ``min(3 * size, level * weight)`` with the level at which the targets add up to all sizes; that
    is where capping and sharing the excess again by weight ends. With sources ordered by cap per
    weight, the capped ones come first, so running sums give the level of every possible cut. The
    table has a row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.encode("source", "UTF-8"))
    by_cap = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.encode("source", "UTF-8"))
    before, onward = by_cap.rowsBetween(Window.unboundedPreceding, -1), by_cap.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy()
    ranked = (
        sizes.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
        .withColumn("cap", MOST_EPOCHS * F.col("source_size"))
        .withColumn("room", F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
        .withColumn("level", F.col("room").cast("double") / F.sum("weight").over(onward))
    )
    fits = F.col("level") * F.col("weight") <= F.col("cap")
    level = F.min(F.when(fits, F.struct(F.col("cap") / F.col("weight"), "level"))).over(everything)["level"]
    return ranked.withColumn("target", F.least(F.col("cap").cast("double"), level * F.col("weight"))).select(
        "source", "source_size", "target"
    )


def mix(docs: DataFrame, text: str = "text", seed: int = 7, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """How many words of each document the mix takes.

    ``docs``: doc_id, source and a text column. Returns doc_id, size (words), source_size, target and
    taken, a row per input row. Each source is put into the random order of a hash of (seed, doc_id);
    whole epochs repeat every document, and the last one is cut where the running sum of sizes meets
    the source's budget, the target's whole part. The cut may fall inside a document, which then counts in part.

    The order is kept in buckets of the hash, each a range of it: a running sum inside the bucket plus
    the total of the source's earlier buckets is the running sum over the source, so no task holds a
    source. Ties of the hash go by doc_id, then size; rows with the same doc_id and size are alike and
    their shares are dealt in some order. The result depends on neither the buckets nor the partitions.
    Null text: size 0, taken 0. Null doc_id: hashed as null. An empty table gives an empty result.
    A very long text is measured whole. Other columns are not read, whatever their names; an empty table gives an empty mix.
    """
    rows = checkpointed(
        docs.select("doc_id", "source", n_words(text).alias("size")).withColumn("key", random_key(seed))
    )
    counted = rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("_rows"))
    buckets = max(1, -(-rows.count() // bucket_rows))
    goal = targets(counted.select("source", "source_size"))
    # Equal shares of the hash's range, by its first 32 bits.
    first = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    placed = rows.withColumn("bucket", F.floor(first * F.lit(buckets) / F.lit(1 << 32)).cast("long"))
    order = Window.partitionBy("source", "bucket").orderBy("key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = placed.withColumn("before", F.coalesce(F.sum("size").over(order), F.lit(0)))
    totals = placed.groupBy("source", "bucket").agg(F.sum("size").alias("total"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("source").alias("_source"), F.col("bucket").alias("_bucket"), F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("offset")
    )
    goal = goal.withColumnRenamed("source", "_name")
    joined = inside.join(offsets, F.col("source").eqNullSafe(F.col("_source")) & (F.col("bucket") == F.col("_bucket"))).join(
        goal, F.col("source").eqNullSafe(F.col("_name"))
    )
    budget = F.floor("target")
    epochs = F.when(F.col("source_size") > 0, F.floor(budget / F.col("source_size"))).otherwise(0)
    rest = budget - epochs * F.col("source_size")
    last = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("offset") - F.col("before")))
    return joined.select(
        "doc_id", "size", "source_size", "target", (epochs * F.col("size") + last).cast("long").alias("taken")
    )


def mixed(docs: DataFrame, seed: int = 7) -> DataFrame:
    """The documents of the mix with their columns, each as often as it is taken, whole.

    A document that the cut divides is taken whole, so a source passes its budget by less than one
    document. Rows with the same doc_id count as one document of their first source and text.
    """
    plan = (
        mix(docs, seed=seed)
        .groupBy("doc_id")
        .agg(F.max(F.when(F.col("size") > 0, F.ceil(F.col("taken") / F.col("size"))).otherwise(0)).cast("int").alias("_copies"))
        .select(F.col("doc_id").alias("_taken_id"), "_copies")
        .filter("_copies > 0")
    )
    row = F.struct(*[F.col(c) for c in docs.columns])
    packed = docs.select(row.alias("_row"), F.col("doc_id").alias("_row_id"))
    return (
        packed.join(plan, F.col("_row_id").eqNullSafe(F.col("_taken_id")))
        .select("_row", F.explode(F.sequence(F.lit(1), F.col("_copies"))).alias("_copy"))
        .select("_row.*")
    )
