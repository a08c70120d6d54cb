"""Line dedup over edit distance by joining deletion neighbourhoods.

A line goes if an earlier one, by (doc_id, line number), has the same words, or for lines of eight words or more, if it is one
word edit away (a word put in, left out or replaced). Equal lines are grouped by a hash of their words; the
first of each group goes on. Of two lines one edit apart the first or the last half of the words is equal, so only lines that share a
half with another one emit variants: the hash of the line without each word of the other half, with that word's place, and the
hash of the whole line. Equal variants are joined and verified: a whole line and a variant are one
edit apart, two variants only if the same place was left out. No pairs are made: the earliest line of each
kind under a key is an aggregate, and each line looks up the earliest that is within the bound.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import hash_map, in_map, stored

#: Words from which a line may differ in one.
LONG = 8
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_NO_ID = np.iinfo(np.int64).max


class Lines:
    """Lines with words of a text column: ``row``, ``line`` (from 0), first word ``a`` and past the last ``b``."""

    def __init__(self, column: pa.Array):
        w = self.words = textkit.Words(column)
        breaks = np.flatnonzero(w.data == 10)
        number = np.searchsorted(breaks, w.starts)
        rows = w.rows()
        new = np.ones(len(w), bool)
        new[1:] = (rows[1:] != rows[:-1]) | (number[1:] != number[:-1])
        self.a = np.flatnonzero(new)
        self.b = np.append(self.a[1:], len(w))
        self.row = rows[self.a]
        self.line = number[self.a] - np.searchsorted(breaks, w.offsets[self.row])
        up, self._down = textkit.powers(len(w) + 2)
        self._sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(w.hashes * up[: len(w)], dtype=np.uint64)])

    def hashes(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Hash of the words a to b."""
        return textkit.mix((self._sums[b] - self._sums[a]) * self._down[a] + (b - a).astype(np.uint64) * _LENGTH)

    def without(self, k: np.ndarray) -> np.ndarray:
        """For lines k, one after the other: hash of the line without each of its words."""
        n = self.b[k] - self.a[k]
        a, b, i = np.repeat(self.a[k], n), np.repeat(self.b[k], n), textkit.ragged(self.a[k], n)
        value = (self._sums[i] - self._sums[a]) * self._down[a] + (self._sums[b] - self._sums[i + 1]) * self._down[a + 1]
        return textkit.mix(value + (b - a - 1).astype(np.uint64) * _LENGTH)

    def halves(self, k: np.ndarray) -> list[np.ndarray]:
        """Hashes of half-lines: first and last words, half of n and half of n - 1 of them."""
        n, out = self.b[k] - self.a[k], []
        for h in (n // 2, (n - 1) // 2):
            out.append(self.hashes(self.a[k], self.a[k] + h) ^ np.uint64(1))
            out.append(self.hashes(self.b[k] - h, self.b[k]) & ~np.uint64(1) ^ np.uint64(2))
        return out


def _line_rows(docs: DataFrame) -> DataFrame:
    """doc, line, n, full, heads and tails (hashes of halves), a row per line with words."""
    longs = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                found = Lines(part.column("text"))
                n = found.b - found.a
                full = found.hashes(found.a, found.b).view(np.int64)
                long = np.flatnonzero(n >= LONG)
                one, two, three, four = (x.view(np.int64) for x in found.halves(long))
                count = np.zeros(len(n) + 1, np.int32)
                count[long + 1] = 1 + (one != three)
                ends = np.cumsum(count, dtype=np.int32)
                second = one != three
                place = ends[long]
                heads, tails = np.empty(ends[-1], np.int64), np.empty(ends[-1], np.int64)
                heads[place], tails[place] = one, two
                heads[place[second] + 1], tails[place[second] + 1] = three[second], four[second]
                ids = part.column("doc").take(pa.array(found.row))
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (heads, tails)]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(found.line), pa.array(n), pa.array(full), *lists], ["doc", "line", "n", "full", "heads", "tails"]
                )

    return docs.mapInArrow(run, "doc long, line long, n long, full long, heads array<long>, tails array<long>")


def _variants(docs: DataFrame, wanted) -> DataFrame:
    """doc, line, full, keys (hash of the line without each word) of lines of LONG words whose hash is on the map."""
    longs = pa.list_(pa.int64())

    def run(batches):
        bits = wanted.value
        for batch in batches:
            for part in textkit.slices(batch, "text"):
                found = Lines(part.column("text"))
                full = found.hashes(found.a, found.b)
                k = np.flatnonzero(in_map(bits, full) & (found.b - found.a >= LONG))
                ends = np.concatenate([[0], np.cumsum(found.b[k] - found.a[k])]).astype(np.int32)
                keys = pa.ListArray.from_arrays(pa.array(ends), pa.array(found.without(k).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc").take(pa.array(found.row[k])), pa.array(found.line[k]), pa.array(full[k].view(np.int64)), keys.cast(longs)],
                    ["doc", "line", "full", "keys"],
                )

    return docs.mapInArrow(run, "doc long, line long, full long, keys array<long>")


def _shared_halves(firsts: DataFrame, side: str) -> DataFrame:
    """doc, line of first lines that share a half with another one."""
    keyed = firsts.select("doc", "line", F.explode(side).alias("half"))
    common = stored(keyed.groupBy("half").agg(F.count("*").alias("size")).filter("size > 1").select("half"), "halves")
    return keyed.join(common, "half").select("doc", "line", F.lit(True).alias(f"by_{side}")).distinct()


def _earlier(order: Column) -> Column:
    return F.when(order < F.struct("doc", "line"), order)


def line_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """Lines that go: doc_id, line, first_doc_id, first_line, edits (0 or 1); and lines_of for those that stay.

    Lines are split at \\n and numbered from 0; words are runs without white space, A-Z folded, so
    lines that differ only in white space or case are equal. Lines without words never go. Judged on the input: an earlier line counts even if it goes itself.
    ``first_*`` is the earliest equal line (edits 0), or else the earliest one edit away. Null and empty texts have
    no lines. A null doc_id comes after all others. Lines with the same doc_id and number (repeated rows) don't remove each other. Words and lines are told by 64-bit hashes.
    A very long text is split like any other, and its lines are dealt on their own. Other columns are not read, whatever their names; an empty table gives no rows.
    """
    return _verdicts(docs, text)[1]


def _verdicts(docs: DataFrame, text: str) -> tuple[DataFrame, DataFrame]:
    given = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text).alias("text"))
    lines = stored(_line_rows(given), "lines")
    groups = lines.groupBy("full").agg(F.min(F.struct("doc", "line")).alias("first"), F.count("*").alias("size")).filter("size > 1")
    # Tables that hot keys are joined with are stored first, so that those joins can split the keys.
    placed = stored(lines.join(stored(groups, "groups"), "full", "left").withColumn("equal", _earlier(F.col("first"))), "placed")
    equal = placed.filter("equal IS NOT NULL").select("doc", "line", F.col("equal").alias("first"), F.lit(0).alias("edits"))

    firsts = placed.filter(f"equal IS NULL AND n >= {LONG}").select("doc", "line", "full", "heads", "tails").distinct()
    halves = _shared_halves(firsts, "heads").join(_shared_halves(firsts, "tails"), ["doc", "line"], "full")
    near = stored(firsts.select("doc", "line", "full").join(halves, ["doc", "line"]), "near")
    texts = _variants(given, hash_map(near, "full")).distinct()
    chosen = texts.join(near, ["doc", "line", "full"])
    # An equal first half leaves the edit to the words behind it, an equal last half to those before.
    half = F.floor((F.size("keys") - 1) / 2)
    places = F.transform("keys", lambda key, i: F.struct(i.cast("long").alias("place"), key.alias("key")))
    wanted = F.filter(places, lambda x: (F.col("by_heads") & (x.place >= half)) | (F.col("by_tails") & (x.place < F.size("keys") - half)))
    whole = F.array(F.struct(F.lit(-1).cast("long").alias("place"), F.col("full").alias("key")))
    both = F.concat(whole, F.coalesce(wanted, F.array().cast("array<struct<place:long,key:long>>")))
    variants = stored(
        chosen.withColumns({"by_heads": F.coalesce("by_heads", F.lit(False)), "by_tails": F.coalesce("by_tails", F.lit(False))})
        .select("doc", "line", F.size("keys").alias("n"), F.explode(both).alias("v")).select("doc", "line", "n", "v.place", "v.key"),
        "variants",
    )
    kinds = variants.groupBy("key", "place", "n").agg(F.min(F.struct("doc", "line")).alias("least"), F.count("*").alias("size"))
    # Under a key: whole lines, and variants of lines one word longer, by the place left out.
    longer = (F.col("place") >= 0) & (F.col("n") > LONG)
    keys = kinds.groupBy("key").agg(
        F.min(F.when(F.col("place") < 0, F.col("least"))).alias("whole"), F.min(F.when(longer | (F.col("place") < 0), F.col("least"))).alias("any"),
        F.sum("size").alias("members"),
    ).filter("members > 1")
    bound = F.when(F.col("place") < 0, F.col("any")).when(F.col("n") > LONG, F.least("least", "whole")).otherwise(F.col("least"))
    nearest = stored(kinds.join(keys, "key").select("key", "place", "n", bound.alias("bound")), "nearest")
    matched = (
        variants.join(nearest, ["key", "place", "n"])
        .withColumn("near", _earlier(F.col("bound"))).filter("near IS NOT NULL")
        .groupBy("doc", "line").agg(F.min("near").alias("first"))
        .select("doc", "line", "first", F.lit(1).alias("edits"))
    )
    gone = equal.union(matched)
    id_of = lambda c: F.when(F.col(c) != _NO_ID, F.col(c))
    return lines, gone.select(id_of("doc").alias("doc_id"), "line", id_of("first.doc").alias("first_doc_id"), F.col("first.line").alias("first_line"), "edits")


def line_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_lines (with words), n_equal, n_near, n_kept for each doc_id; rows of one doc_id count together.

    Null, empty and very long texts, ties and other columns: as in line_duplicates; a document without lines counts 0 everywhere.
    """
    lines, gone = _verdicts(docs, text)
    counted = lines.groupBy("doc").agg(F.count("*").alias("n_lines"))
    lost = gone.groupBy(F.coalesce("doc_id", F.lit(_NO_ID)).alias("doc")).agg(
        F.sum(F.when(F.col("edits") == 0, 1).otherwise(0)).alias("n_equal"), F.sum("edits").alias("n_near")
    )
    every = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(_NO_ID)).alias("doc")).distinct()
    n = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return every.join(counted, "doc", "left").join(lost, "doc", "left").select(
        F.when(F.col("doc") != _NO_ID, F.col("doc")).alias("doc_id"), n("n_lines").alias("n_lines"), n("n_equal").alias("n_equal"),
        n("n_near").alias("n_near"), (n("n_lines") - n("n_equal") - n("n_near")).alias("n_kept"),
    )


def without_duplicates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with the text's duplicate lines taken out; other columns and documents stay as they are."""
    gone = line_duplicates(docs, text).groupBy(F.col("doc_id").alias("_doc")).agg(F.collect_set("line").alias("_gone"))
    row = docs.select(F.struct(*docs.columns).alias("_row"))
    joined = row.join(gone, F.col("_row.doc_id").eqNullSafe(F.col("_doc")), "left")
    kept = F.filter(F.split(F.col("_row")[text], "\n", -1), lambda line, i: ~F.array_contains("_gone", i.cast("long")))
    cut = F.when(F.col("_gone").isNull(), F.col("_row")[text]).otherwise(F.array_join(kept, "\n"))
    return joined.withColumn("_text", cut).select(*[F.col("_text").alias(c) if c == text else F.col("_row")[c].alias(c) for c in docs.columns])
