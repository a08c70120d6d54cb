"""Ranked lexical search over bit-sliced Bloom signatures.

Index. Each document has a Bloom signature of its terms; a term that occurs twice or more is entered again as (term, level) for
each level of THRESHOLDS it reaches. Signatures are stored bit-sliced in blocks: a slice is a bitmap over the block's documents, so the
documents that may hold a term often enough are the AND of PROBES slices. A block also has its documents' lengths; beside the blocks
the index holds each term's number of documents.

Search. For each item, slices weighted by term weights are summed level by level. As filters never miss a term
and a term's score rises with its frequency, the sums times what a level may add at most to a document of that length are upper
bounds of the scores. The highest bounds give the first documents to score exactly; the least of their best scores is a proven
limit, and every document whose bound reaches it is scored exactly from its whole text. So no result is lost, whatever the filters
overestimate.

Items go in shards of bounded words, one after the other, so what is sent to the tasks doesn't grow with the benchmark. Terms are
told apart by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import hash_map, in_map, pieces, stored

#: Occurrences at which a term is entered once more.
THRESHOLDS = [1, 2, 3, 5, 9, 17, 33]
#: Slices of an entry, and bits of a signature for each entry (up to twice as many).
PROBES, BITS = 2, 12
LEAST_WIDTH = 512
#: Terms whose counts a task holds before it gives them out.
COUNTED = 500_000
#: Words of items in a shard.
SHARD_WORDS = 100_000

INDEX = "width int, n int, keys binary, lengths binary, slices binary, term long, documents long"
_INDEX = pa.schema([("width", pa.int32()), ("n", pa.int32()), ("keys", pa.binary()), ("lengths", pa.binary()), ("slices", pa.binary()), ("term", pa.int64()), ("documents", pa.int64())])


def _places(terms: np.ndarray, level: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two places of (term, level) in a signature of ``width`` bits, a power of two."""
    mixed = textkit.mix(terms + np.uint64(level * 0x9E3779B97F4A7C15 % (1 << 64)))
    mask = np.uint64(width - 1)
    return (mixed & mask).astype(np.int64), ((mixed >> np.uint64(32)) & mask).astype(np.int64)


def _frequencies(words: textkit.Words):
    """(row, term, occurrences) of the distinct terms of each row, by row."""
    terms, code = np.unique(words.hashes, return_inverse=True)
    both, times = np.unique(words.rows() * max(1, len(terms)) + code, return_counts=True)
    return both // max(1, len(terms)), terms[both % max(1, len(terms))], times


def _blocks(keys: np.ndarray, words: textkit.Words):
    """INDEX rows of the signatures of a piece's documents, a block for each width; and its distinct terms with their documents."""
    row, term, times = _frequencies(words)
    lengths = np.diff(words.first)
    entries = np.zeros(len(lengths), np.int64)
    for least in THRESHOLDS:
        entries += np.bincount(row[times >= least], minlength=len(lengths))
    width = np.maximum(LEAST_WIDTH, 1 << np.ceil(np.log2(np.maximum(1, BITS * entries))).astype(np.int64))
    width[lengths == 0] = 0  # documents without terms are no documents of the index
    out = []
    for size in np.unique(width[width > 0]).tolist():
        mine = np.flatnonzero(width == size)
        column = np.full(len(lengths), -1)
        column[mine] = np.arange(len(mine))
        bits = np.zeros((size, len(mine)), bool)
        for level, least in enumerate(THRESHOLDS):
            at = np.flatnonzero((times >= least) & (column[row] >= 0))
            for place in _places(term[at], level, size):
                bits[place, column[row[at]]] = True
        slices = pa.compress(np.packbits(bits, axis=1).tobytes(), codec="zstd", asbytes=True)
        out.append({"width": size, "n": len(mine), "keys": keys[mine].astype("<i8").tobytes(), "lengths": lengths[mine].astype("<i8").tobytes(), "slices": slices})
    return out, np.unique(term, return_counts=True)


def index(docs: DataFrame, text: str = "text") -> DataFrame:
    """INDEX rows over all documents, stored: blocks of signatures (width set), and the documents of each term, in parts (term set)."""

    def build(batches):
        terms, counts, held = [], [], 0

        def counted():
            if terms:
                term, code = np.unique(np.concatenate(terms), return_inverse=True)
                n = np.bincount(code, np.concatenate(counts)).astype(np.int64)
                empty = [pa.nulls(len(term), field.type) for field in list(_INDEX)[:5]]
                yield pa.RecordBatch.from_arrays([*empty, pa.array(term.view(np.int64)), pa.array(n)], schema=_INDEX)

        for batch in batches:
            for part in textkit.slices(batch, "text"):
                blocks, (term, n) = _blocks(part.column("key").to_numpy(), textkit.Words(part.column("text"), textkit.ALNUM))
                for block in blocks:
                    yield pa.RecordBatch.from_pylist([block], _INDEX)
                terms.append(term)
                counts.append(n)
                held += len(term)
                if held > COUNTED:
                    yield from counted()
                    terms, counts, held = [], [], 0
        yield from counted()

    return stored(_keyed(docs, text).select("key", "text").mapInArrow(build, INDEX), "signatures")


def _keyed(docs: DataFrame, text: str) -> DataFrame:
    """key, doc_id, text; rows with equal keys are equal or, if a hash clashes, scored each by its own text all the same."""
    return docs.select("doc_id", F.col(text).alias("text")).select(F.xxhash64("doc_id", "text").alias("key"), "doc_id", "text")


class Pack(NamedTuple):
    """A shard of items for the tasks: its terms, and for each item the places of its terms and their weights, repeats included."""

    terms: np.ndarray
    items: list[tuple[np.ndarray, np.ndarray]]
    n_docs: int
    n_terms: int

    def offset(self, lengths: np.ndarray) -> np.ndarray:
        """What a document's length adds below the line: 12 m."""
        return 12 * (100 - 25 + (25 * lengths * self.n_docs) // self.n_terms)


def part_score(times: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Score of a term of weight one that occurs ``times`` times; rises with ``times``."""
    return (1_000_000_000 * times) // (1000 * times + offset)


def weight(n_docs: int, documents: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * documents + 1)))


def bounds(pack: Pack, width: int, lengths: np.ndarray, slices: np.ndarray) -> np.ndarray:
    """Upper bounds of the scores, items by documents, from weighted sums of slices."""
    n, offset = len(lengths), pack.offset(lengths)
    out = np.zeros((len(pack.items), n), np.int64)
    may, below = None, np.zeros(n, np.int64)
    for level, least in enumerate(THRESHOLDS):
        first, second = _places(pack.terms, level, width)
        held = slices[first] & slices[second]
        may = held if may is None else may & held
        # Documents in which a term occurs least times at least: it adds what the most occurrences of this level add.
        most = np.full(n, THRESHOLDS[level + 1] - 1) if level + 1 < len(THRESHOLDS) else lengths
        here = np.maximum(below, part_score(np.minimum(most, lengths), offset))
        live = may.any(axis=1)
        if not live.any():
            break
        bits = np.unpackbits(may, axis=1, count=n)
        for item, (terms, weights) in enumerate(pack.items):
            on = live[terms]
            if on.any():
                sums = weights[on].astype(np.float64) @ bits[terms[on]]  # whole numbers below 2^53: exact
                out[item] += sums.astype(np.int64) * (here - below)
        below = here
    return out


def _read_blocks(batch):
    for row in batch.to_pylist():
        wide = -(-row["n"] // 8)
        slices = np.frombuffer(pa.decompress(row["slices"], row["width"] * wide, codec="zstd", asbytes=True), np.uint8).reshape(-1, wide)
        yield row["width"], np.frombuffer(row["keys"], "<i8"), np.frombuffer(row["lengths"], "<i8"), slices


_FOUND = "item int, key long, bound long"


def _found(items, keys, values) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), pa.array(keys, pa.int64()), pa.array(values, pa.int64())], ["item", "key", "bound"])


def highest_bounds(blocks: DataFrame, pack, top: int) -> DataFrame:
    """item, key, bound: the ``top`` highest bounds above 0 of each item."""

    def best(batches):
        q = pack.value
        bound, key = np.zeros((len(q.items), 0), np.int64), np.zeros((len(q.items), 0), np.int64)
        for batch in batches:
            for width, keys, lengths, slices in _read_blocks(batch):
                bound = np.hstack([bound, bounds(q, width, lengths, slices)])
                key = np.hstack([key, np.broadcast_to(keys, (len(q.items), len(keys)))])
                if bound.shape[1] > top:
                    keep = np.argpartition(bound, -top, axis=1)[:, -top:]
                    bound, key = np.take_along_axis(bound, keep, 1), np.take_along_axis(key, keep, 1)
        item, column = np.nonzero(bound)
        yield _found(item, key[item, column], bound[item, column])

    order = Window.partitionBy("item").orderBy(F.desc("bound"), "key")
    return blocks.mapInArrow(best, _FOUND).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top).drop("rank")


def reaching(blocks: DataFrame, pack, limits) -> DataFrame:
    """item, key, bound: all documents whose bound reaches the item's limit."""

    def reach(batches):
        for batch in batches:
            for width, keys, lengths, slices in _read_blocks(batch):
                bound = bounds(pack.value, width, lengths, slices)
                item, column = np.nonzero(bound >= limits.value[:, None])
                yield _found(item, keys[column], bound[item, column])

    return blocks.mapInArrow(reach, _FOUND)


def rescored(rows: DataFrame, found: DataFrame, pack) -> DataFrame:
    """item, doc_id, score: exact scores above 0 of the documents found for each item, from their whole texts."""
    wanted = stored(found.groupBy("key").agg(F.collect_set("item").alias("items")), "candidates")
    maybe = hash_map(wanted, "key")

    def count(batches):
        q = pack.value
        order = np.argsort(q.terms)
        ranked = q.terms[order]
        longs, ints = pa.list_(pa.int64()), pa.list_(pa.int32())
        for batch in batches:
            batch = batch.filter(pa.array(in_map(maybe.value, batch.column("key").to_numpy())))
            for part in textkit.slices(batch, "text"):
                words = textkit.Words(part.column("text"), textkit.ALNUM)
                row, term, times = _frequencies(words)
                at = np.minimum(np.searchsorted(ranked, term), max(0, len(ranked) - 1))
                known = np.flatnonzero(ranked[at] == term) if len(ranked) else np.zeros(0, np.int64)
                ends = pa.array(np.searchsorted(row[known], np.arange(part.num_rows + 1)), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("key"), part.column("doc_id"), pa.array(np.diff(words.first)),
                     pa.ListArray.from_arrays(ends, pa.array(order[at[known]], pa.int32())).cast(ints),
                     pa.ListArray.from_arrays(ends, pa.array(times[known], pa.int64())).cast(longs)],
                    ["key", "doc_id", "length", "terms", "times"],
                )

    def score(batches):
        q = pack.value
        for batch in batches:
            items, ids, scores = [], [], []
            for at, row in enumerate(batch.select(["length", "terms", "times", "items"]).to_pylist()):
                times = np.zeros(len(q.terms), np.int64)
                times[row["terms"]] = row["times"]
                offset = q.offset(np.array([row["length"]]))
                for item in row["items"]:
                    terms, weights = q.items[item]
                    total = int((weights * part_score(times[terms], offset)).sum())
                    if total > 0:
                        items.append(item)
                        ids.append(at)
                        scores.append(total)
            doc_id = batch.column("doc_id").take(pa.array(ids, pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.int32()), doc_id, pa.array(scores, pa.int64())], ["item", "doc_id", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    counted = rows.mapInArrow(count, f"key long, doc_id {kind}, length long, terms array<int>, times array<long>")
    return counted.join(wanted, "key").mapInArrow(score, f"item int, doc_id {kind}, score long")


def _top(scored: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _packed(spark, signatures: DataFrame, texts: list, n_docs: int, n_terms: int) -> Pack:
    """Terms and weights of the items' texts."""
    words = textkit.Words(pa.array(texts, pa.string()), textkit.ALNUM)
    terms = np.unique(words.hashes)
    asked = spark.createDataFrame([(t,) for t in terms.view(np.int64).tolist()], "term long")
    counts = signatures.filter("term IS NOT NULL").join(F.broadcast(asked), "term").groupBy("term").agg(F.sum("documents").alias("documents"))
    # A row for each term of the shard at most.
    weights = {r["term"]: weight(n_docs, r["documents"]) for r in counts.collect()}
    by_place = np.array([weights.get(t, 0) for t in terms.view(np.int64).tolist()], np.int64)
    places, items = np.searchsorted(terms, words.hashes), []
    for a, b in zip(words.first[:-1], words.first[1:]):
        times = Counter(places[a:b].tolist())
        own = np.array(sorted(t for t in times if by_place[t] > 0), np.int64)
        items.append((own, by_place[own] * np.array([times[t] for t in own.tolist()], np.int64)))
    return Pack(terms, items, n_docs, n_terms)


def ranked(docs: DataFrame, items: DataFrame, top: int = 20, text: str = "text", shard_words: int = SHARD_WORDS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``top`` documents of highest score above 0 for each row of ``items`` (item_id, text).

    Equal scores rank by ascending doc_id, nulls last; rows equal in both are in any order, which can't be seen. Repeated
    documents rank each, repeated items get a list each, null item_ids and doc_ids are carried along. Null and empty texts
    have no terms: such documents aren't counted or found, such items find nothing. Other columns are not read. Texts
    are read whole; a very long document is a block of its own, a very long item a shard of its own. Without documents or items
    there are no rows.
    """
    spark = docs.sparkSession
    kinds = items.schema["item_id"].dataType.simpleString(), docs.schema["doc_id"].dataType.simpleString()
    rows, signatures = _keyed(docs, text), index(docs, text)
    blocks = signatures.filter("width IS NOT NULL").select("width", "n", "keys", "lengths", "slices")

    def lengths(batches):
        for batch in batches:
            sums = [int(np.frombuffer(x, "<i8").sum()) for x in batch.column("lengths").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("n").cast(pa.int64()), pa.array(sums, pa.int64())], ["n_docs", "n_terms"])

    total = blocks.select("n", "lengths").mapInArrow(lengths, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    asked = items.select("item_id", "text")
    words = asked.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_shards = pieces(words // 2, shard_words, 1) if total[0] else 0
    results = [spark.createDataFrame([], f"item_id {kinds[0]}, rank int, doc_id {kinds[1]}, score long")]
    for shard in range(n_shards):
        # At most shard_words words or a single longer item, on average over the hash.
        mine = asked.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_shards)) == shard).collect()
        pack_here = _packed(spark, signatures, [r["text"] for r in mine], *total)
        pack = spark.sparkContext.broadcast(pack_here)
        first = _top(rescored(rows, highest_bounds(blocks, pack, top), pack), top)
        # A row for each item: the least of `top` exact scores is a limit that the best documents reach.
        least = first.groupBy("item").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).filter(F.col("n") == top).collect()
        limit = np.ones(len(mine), np.int64)
        for r in least:
            limit[r["item"]] = max(1, r["least"])
        limits = spark.sparkContext.broadcast(limit)
        best = _top(rescored(rows, reaching(blocks, pack, limits), pack), top)
        names = spark.createDataFrame([(k, r["item_id"]) for k, r in enumerate(mine)], f"item int, item_id {kinds[0]}")
        results.append(stored(best.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score"), "ranked"))
        for sent in (pack, limits):
            sent.unpersist()
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out
