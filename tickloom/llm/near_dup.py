"""Near-duplicate documents: banded MinHash, odd sketches, exact links, components.

A signature pass gives each document the keys of its MinHash bands and an odd sketch: its MinHash samples,
one per part of the hash space, hashed to bits of a bitmap that keeps parities. The XOR of two
sketches has about as many bits as the samples differ, most precisely where they differ little, so it
tells which candidates can reach the similarity wanted. Those that can are confirmed on the shingles of the
whole texts, until components no longer change.

Documents with the same shingles are one class, and classes are linked, so copies never meet in pairs. In a band's
bucket every class is first compared with the bucket's hub, the one that shares most bands with others. Links found join classes into
components. What could still join two components is found in the buckets that hold several: of their classes only
those that can reach the similarity at all are looked at. For that
each class counts its shingles that some other component holds too (packed keys, blocks.py); what two classes of different components
have in common is no more than the smaller count. The classes outside a bucket's main component then meet those of other components
at their rarest shingles (``rare_pairs``), not pair by pair in the bucket. So no bucket emits all its pairs, and none loses a link that could
join two components. Candidates are confirmed likeliest first, and only between different components.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickloom.llm import blocks as B
from tickloom.llm import components, textkit
from tickloom.llm.common import by_size, hash_map, in_map, pieces, stored, text_bytes

#: Bands and MinHashes in a band: a pair of similarity 0.8 shares no band with a chance of 3 in a million.
BANDS, ROWS = 32, 5
#: Parts of the hash space that give a sample each, and bits of a sketch.
PARTS, BITS = 1024, 2048
#: Standard deviations that a candidate's estimate may fall short.
DEVIATIONS = 5.0
#: Candidates of a node that are confirmed in one go: the likeliest, then all.
STEPS = (1, 1 << 30)
_SEEDS = np.random.default_rng(5).integers(0, 1 << 32, (2, BANDS * ROWS), dtype=np.uint64).astype(np.uint32)
_XOR, _TIMES = _SEEDS[0][:, None], _SEEDS[1][:, None] | np.uint32(1)


def shingles(words: textkit.Words, row: int, width: int) -> np.ndarray:
    """Sorted distinct hashes of a row's windows of ``width`` words; all words as one if there are fewer."""
    h = words.hashes[words.first[row] : words.first[row + 1]]
    if not len(h):
        return h
    n = max(1, len(h) - width + 1)
    out = h[:n] * np.uint64(0x9E3779B97F4A7C15)
    for k in range(1, min(width, len(h))):
        out = textkit.mix(out) + h[k : k + n]
    return np.unique(textkit.mix(out))


def min_hashes(found: np.ndarray) -> np.ndarray:
    small = (found >> np.uint64(32)).astype(np.uint32)
    out = np.full(BANDS * ROWS, np.iinfo(np.uint32).max, np.uint32)
    for at in range(0, len(small), 1024):
        np.minimum(out, ((small[at : at + 1024] ^ _XOR) * _TIMES).min(axis=1), out=out)
    return out


def band_keys(least: np.ndarray) -> np.ndarray:
    key = np.arange(BANDS, dtype=np.uint64) + np.uint64(1)
    for column in least.reshape(BANDS, ROWS).T:
        key = textkit.mix(key * np.uint64(0x9E3779B97F4A7C15) + column)
    return key.view(np.int64)


def odd_sketch(found: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of samples, and the parity bitmap as 64-bit words. Samples: the least hash of each part that has any."""
    part = found >> np.uint64(64 - PARTS.bit_length() + 1)
    sample = found[np.concatenate([[True], part[1:] != part[:-1]])]
    parity = np.bincount((textkit.mix(sample + np.uint64(99)) % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return len(sample), np.packbits(parity.astype(np.uint8), bitorder="little").view("<i8")


def signatures(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, n (shingles), key_1, key_2 (of the set), samples, sketch, bands; a null text has none of them."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    longs = pa.list_(pa.int64())

    def run(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text", textkit.SLICE):
                words = textkit.Words(part.column("text"))
                n, one, two, samples, sketches, bands = [], [], [], [], [], []
                for row in range(part.num_rows):
                    found = shingles(words, row, width)
                    n.append(len(found))
                    one.append(int(found.sum(dtype=np.uint64).view(np.int64)))
                    two.append(int(np.bitwise_xor.reduce(textkit.mix(found)).view(np.int64)) if len(found) else 0)
                    count, sketch = odd_sketch(found) if len(found) else (0, None)
                    samples.append(count)
                    sketches.append(sketch)
                    bands.append(band_keys(min_hashes(found)) if len(found) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, one, two, samples)), pa.array(sketches, longs), pa.array(bands, longs)],
                    ["doc_id", "n", "key_1", "key_2", "samples", "sketch", "bands"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n long, key_1 long, key_2 long, samples long, sketch array<long>, bands array<long>"
    )


def by_sketches(a, b, percent: int) -> tuple[Column, Column]:
    """Of two nodes' columns n, samples and sketch, named by ``a`` and ``b``: whether their sketches allow the similarity,
    and the share of samples that they are estimated to have in common.

    Samples shared: half of what both sketches have together and don't differ in.
    """
    bits = F.zip_with(a("sketch"), b("sketch"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    odd = F.greatest(1 - 2 * F.aggregate(bits, F.lit(0), lambda n, x: n + x) / F.lit(BITS), F.lit(1e-3))
    n_a, n_b, both = F.col(a("n")), F.col(b("n")), F.col(a("samples")) + F.col(b("samples"))
    shared = (both - F.log(odd) / F.lit(math.log(1 - 2 / BITS))) / 2
    union = (n_a + n_b) * 100 / F.lit(100 + percent)
    parts = F.lit(float(PARTS)) * (1 - F.pow(F.lit(1 - 1 / PARTS), union))
    # Of the number of parts that have any: the union falls into more or fewer than expected.
    load = union / PARTS
    filled = F.lit(percent * percent / 10_000) * F.greatest(F.lit(0.0), F.lit(float(PARTS)) * (F.exp(-load) - (1 + load) * F.exp(-2 * load)))
    # Of the share of samples: parts drawn from the union without putting back.
    drawn = F.lit(percent * (100 - percent) / 10_000) * parts * F.greatest(F.lit(0.0), 1 - parts / union)
    # Of the sketch: bits hit an even number of times, at as many differing samples as the similarity allows.
    differ = F.greatest(both - 2 * F.lit(percent / 100) * parts, F.lit(0.0))
    left = F.exp(differ * F.lit(-4 / BITS))
    folded = F.greatest(F.lit(BITS / 4) * (1 - left) - differ * left, F.lit(0.0)) / left / 4
    least = parts * F.lit(percent / 100) - F.lit(DEVIATIONS) * F.sqrt(filled + drawn + folded) - 2
    sized = 100 * F.least(n_a, n_b) >= percent * F.greatest(n_a, n_b)
    return sized & (shared >= least), shared / parts


def candidates(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs (a, b), those whose sketches allow the similarity; with ``score``, the estimated share."""
    side = lambda s: nodes.select(*[F.col(c).alias(s if c == "node" else f"{c}_{s}") for c in ("node", "n", "samples", "sketch")])
    allowed, score = by_sketches(lambda c: f"{c}_a", lambda c: f"{c}_b", percent)
    return pairs.join(side("a"), "a").join(side("b"), "b").filter(allowed).select("a", "b", score.alias("score"))


def texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """node, text of the wanted documents. A map of fixed size goes to the tasks that read, so that most
    other texts never move; a join then keeps exactly the wanted ones."""
    sent = hash_map(nodes.select(F.xxhash64("node").alias("hash")), "hash")

    def run(batches):
        for batch in batches:
            hashes = batch.column("hash").to_numpy()
            yield batch.filter(pa.array(in_map(sent.value, hashes))).select(["node", "text"])

    rows = docs.select(F.col("doc_id").alias("node"), "text").filter("node IS NOT NULL AND text IS NOT NULL")
    kind = rows.schema["node"].dataType.simpleString()
    return rows.withColumn("hash", F.xxhash64("node")).mapInArrow(run, f"node {kind}, text string").join(nodes, "node", "left_semi")


def shared_counts(texts: DataFrame, total_bytes: int, width: int) -> DataFrame:
    """node, shared: for each row (node, label, text), its shingles that a row with another label holds too."""
    given = texts.select(F.col("label").alias("doc_id"), F.to_json(F.struct("node")).alias("name"), "node", "text")
    n = pieces(total_bytes, B.BLOCK_BYTES)
    kind = given.schema["node"].dataType.simpleString()
    blocks = given.select(F.pmod(F.xxhash64("name"), F.lit(n)).alias("block"), "doc_id", "node", "text").repartition(max(8, n // 8), "block")
    bits = B.key_bits(total_bytes, 8)

    def keys_of(table: pa.Table) -> tuple[B.Keys, np.ndarray]:
        words = textkit.Words(table.column("text"))
        sets = [shingles(words, row, width) for row in range(table.num_rows)]
        sizes = np.array([len(x) for x in sets], np.int64)
        labels = B.first_of(table.column("doc_id").combine_chunks())
        return B.Keys(np.concatenate([np.zeros(0, np.uint64), *sets]), np.repeat(labels, sizes)), sizes

    def count(table: pa.Table, replies: pa.Table) -> pa.Table:
        if not table.num_rows:
            return pa.table({"node": table.column("node"), "shared": pa.array([], pa.int64())})
        keys, sizes = keys_of(table)
        hit = keys.codes(bits, B.by_bucket(replies, 1))[keys.inverse] > 0
        rows = np.repeat(np.arange(len(sizes)), sizes)
        return pa.table({"node": table.column("node"), "shared": pa.array(np.bincount(rows[hit], minlength=len(sizes)), pa.int64())})

    replies = B.shared_keys(blocks, lambda table: keys_of(table)[0], bits, 0)
    return blocks.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(count, f"node {kind}, shared long")


def confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b, linked) after comparing the shingles of the whole texts."""
    a, b = (texts.select(F.col("node").alias(s), F.col("text").alias(f"text_{s}")) for s in "ab")
    kind = pairs.schema["a"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text_a", textkit.SLICE):
                one, two = textkit.Words(part.column("text_a")), textkit.Words(part.column("text_b"))
                linked = []
                for row in range(part.num_rows):
                    x, y = shingles(one, row, width), shingles(two, row, width)
                    same = len(np.intersect1d(x, y, assume_unique=True))
                    linked.append(bool(100 * same >= percent * (len(x) + len(y) - same)) and len(x) > 0)
                yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(linked)], ["a", "b", "linked"])

    return pairs.select("a", "b").join(a, "a").join(b, "b").mapInArrow(run, f"a {kind}, b {kind}, linked boolean")


class _State:
    """Components found so far, and pairs that were compared in full and aren't linked."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, width: int, percent: int):
        self.docs, self.nodes, self.width, self.percent = docs, nodes, width, percent
        self.known: DataFrame | None = None
        self.unlinked: DataFrame | None = None

    def labelled(self, rows: DataFrame, node: str, label: str) -> DataFrame:
        if self.known is None:
            return rows.withColumn(label, F.col(node))
        own = by_size(self.known).select(F.col("node").alias(node), F.col("label").alias("_label"))
        return rows.join(own, node, "left").withColumn(label, F.coalesce("_label", node)).drop("_label")

    def apart(self, pairs: DataFrame) -> DataFrame:
        """Pairs of different components."""
        return self.labelled(self.labelled(pairs, "a", "la"), "b", "lb").filter("la <> lb").drop("la", "lb")

    def compare(self, pairs: DataFrame) -> None:
        """Confirms the candidates among pairs of different components, likeliest first, until none joins two of them."""
        left = candidates(pairs, self.nodes, self.percent)
        if self.unlinked is not None:
            left = left.join(by_size(self.unlinked), ["a", "b"], "left_anti")
        texts = None
        for each in STEPS:
            ranks = [F.row_number().over(Window.partitionBy(end).orderBy(F.desc("score"), other)).alias(f"r{end}") for end, other in ("ab", "ba")]
            left = stored(left.select("a", "b", "score", *ranks), "open")
            if not left.limit(1).count():
                return
            if texts is None:
                ends = stored(left.select(F.col("a").alias("node")).union(left.select("b")).distinct(), "ends")
                texts = stored(texts_of(self.docs, ends), "texts")
            likely = (F.col("ra") <= each) | (F.col("rb") <= each)
            done = stored(confirmed(left.filter(likely), texts, self.width, self.percent), "compared")
            failed = done.filter("NOT linked").select("a", "b")
            self.unlinked = stored(failed if self.unlinked is None else self.unlinked.union(failed), "unlinked")
            if done.filter("linked").limit(1).count():
                self.known = components.merged(self.known, done.filter("linked").select("a", "b"))
            left = self.apart(left.filter(~likely).select("a", "b", "score"))


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for each row of ``docs`` (doc_id, text).

    Documents are linked if their sets of ``width``-word shingles (lower-case A-Z) have ``percent`` / 100 of
    their union in common. A component goes by its smallest doc_id, which is the one kept. Texts without words and null
    texts are linked with nothing. Rows with the same doc_id are one document to the links, and a
    component's kept row is then there more than once. A null doc_id is linked with nothing, its
    component_id is null and it is kept. Shingles are told apart by 64-bit hashes. Empty tables give empty results.
    A very long text is one set of shingles, worked on whole in one task. Other columns are not read, whatever their names.
    """
    rows = stored(signatures(docs, width), "signatures")
    real = rows.filter("n > 0 AND doc_id IS NOT NULL")
    classes = stored(real.groupBy("key_1", "key_2", "n").agg(F.min("doc_id").alias("node")), "classes")
    first = classes.select(F.col("node").alias("doc_id"), "key_1", "key_2", "n")
    nodes = stored(real.join(first, ["doc_id", "key_1", "key_2", "n"], "left_semi").select(F.col("doc_id").alias("node"), "n", "samples", "sketch", "bands"), "nodes")
    plain = nodes.select("node", "n", "samples", "sketch")
    keyed = nodes.select("node", F.posexplode("bands").alias("band", "key"))
    # Stored, so that the joins on it can split a hot key.
    sizes = stored(keyed.groupBy("key").agg(F.count("*").alias("size")).filter("size > 1"), "sizes")
    members = stored(keyed.join(sizes, "key"), "members")
    weights = members.groupBy("node").agg(F.sum("size").alias("weight"))
    weighed = stored(members.join(weights, "node").select("key", "node", "weight"), "weighed")
    hubs = weighed.groupBy("key").agg(F.min(F.struct(-F.col("weight"), "node"))["node"].alias("hub"))
    hubs = stored(hubs, "hubs")

    state = _State(docs, plain, width, percent)
    star = weighed.join(hubs, "key").filter("node <> hub")
    state.compare(star.select(F.least("hub", "node").alias("a"), F.greatest("hub", "node").alias("b")).distinct())
    _compare_rest(state, members.select("key", "node"), plain)

    own = state.labelled(classes.withColumnRenamed("n", "_n"), "node", "label").select("key_1", "key_2", "_n", "label")
    found = rows.join(own, (rows.key_1 == own.key_1) & (rows.key_2 == own.key_2) & (rows.n == own._n) & (rows.n > 0), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def _compare_rest(state: _State, members: DataFrame, nodes: DataFrame, block: int = 1 << 17) -> None:
    """Compares, of each bucket that holds several components, the classes outside its main one with those of other components.

    About ``block`` classes outside look at a time; pairs of components that have joined since are left out.
    """
    mixed = _mixed(state, members)
    ends = stored(mixed.select("node", "label").distinct(), "ends")
    if not ends.limit(1).count():
        return
    texts = stored(texts_of(state.docs, ends.select("node")).join(ends, "node"), "texts")
    shared = shared_counts(texts, text_bytes(texts), state.width).groupBy("node").agg(F.max("shared").alias("shared"))
    able = stored(shared.join(nodes, "node").filter(100 * F.col("shared") >= state.percent * F.col("n")).select("node").distinct(), "able")
    outside = _mixed(state, members.join(able, "node", "left_semi")).filter("label <> main").select("node").distinct()
    outside = stored(outside, "outside")
    entries = rare_shingles(texts.join(able, "node", "left_semi"), outside, state.width, state.percent)
    parts = pieces(outside.count(), block, 1)
    for part in range(parts):
        state.compare(state.apart(rare_pairs(entries, F.pmod(F.xxhash64("node"), F.lit(parts)) == part)))


def rare_shingles(texts: DataFrame, outside: DataFrame, width: int, percent: int) -> DataFrame:
    """hash, node, label, n, least, most, out: the shingles at which rows (node, label, text) may meet sets of ``least`` to ``most`` shingles.

    The shingles that another label holds too are ranked from the most frequent one to the rarest. Of two sets with
    enough shingles in common the rarest common one has that many from it to the most frequent in either set, so
    sets meet only at shingles of such ranks: shingles that make a group of near copies alike rank too low in it.
    """
    kind = texts.schema["node"].dataType.simpleString()

    def run(batches):
        for batch in batches:
            for part in textkit.slices(batch, "text", textkit.SLICE):
                words = textkit.Words(part.column("text"))
                sets = [shingles(words, row, width) for row in range(part.num_rows)]
                sizes = np.array([len(x) for x in sets], np.int64)
                rows = pa.array(np.repeat(np.arange(len(sets)), sizes))
                sums = np.array([x.sum(dtype=np.uint64) for x in sets], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("node").take(rows), part.column("label").take(rows), *(pa.array(np.repeat(x, sizes)) for x in (sums, sizes)),
                     pa.array(np.concatenate([np.zeros(0, np.uint64), *sets]).view(np.int64))],
                    ["node", "label", "text_sum", "n", "hash"],
                )

    held = stored(texts.select("node", "label", "text").mapInArrow(run, f"node {kind}, label {kind}, text_sum long, n long, hash long"), "shingles")
    often = held.groupBy("hash").agg(F.count("*").alias("often"), F.min("label").alias("least"), F.max("label").alias("most")).filter("least <> most")
    # Copies of a text under one doc_id have equal ranks.
    rank = F.dense_rank().over(Window.partitionBy("node", "text_sum").orderBy(F.desc("often"), F.desc("hash")))
    ranked = held.join(often.select("hash", "often"), "hash").select("hash", "node", "label", "n", rank.cast("long").alias("rank"))
    # Shingles in common: (100 + percent) * common >= percent * (n + other n). So a rank allows other sets of so many shingles at most.
    most = F.floor(((100 + percent) * F.col("rank") - percent * F.col("n")) / F.lit(percent))
    least = F.ceil(F.col("n") * percent / 100)
    most = F.least(most, F.floor(F.col("n") * 100 / F.lit(percent)))
    own = ranked.withColumns({"least": least, "most": most}).filter("most >= least")
    return stored(own.join(by_size(outside).withColumn("out", F.lit(True)), "node", "left"), "entries")


def rare_pairs(entries: DataFrame, looking: Column) -> DataFrame:
    """Pairs (a, b) with different labels, one of them outside and ``looking``, that meet at rare shingles: none that may be linked is left out."""
    # Sizes are dealt into cells, so that a shingle joins only sets of the sizes allowed.
    cell = lambda size: F.floor(F.log(size.cast("double")) / F.lit(math.log(1.06)))
    looks = entries.filter(F.col("out") & looking).select(
        "hash", *[F.col(c).alias(f"x_{c}") for c in ("node", "label", "n", "most")], F.explode(F.sequence(cell(F.col("least")), cell(F.col("most")))).alias("cell")
    )
    other = entries.select("hash", "node", "label", "n", "most", "out", cell(F.col("n")).alias("cell"))
    sized = (F.col("n") <= F.col("x_most")) & (F.col("x_n") <= F.col("most"))
    once = F.col("out").isNull() | (F.col("node") < F.col("x_node"))
    met = looks.join(other, ["hash", "cell"]).filter((F.col("label") != F.col("x_label")) & sized & once)
    return met.select(F.least("x_node", "node").alias("a"), F.greatest("x_node", "node").alias("b")).distinct()


def _mixed(state: _State, members: DataFrame) -> DataFrame:
    """Members of buckets with several components, with their label and the bucket's main one."""
    marked = state.labelled(members, "node", "label")
    sizes = marked.groupBy("key", "label").agg(F.count("*").alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "label")).alias("top"), F.count("*").alias("parts")).filter("parts > 1")
    return marked.join(main.select("key", F.col("top.label").alias("main")), "key")


def without_near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` without the rows that near_duplicates doesn't keep, with all their columns."""
    gone = near_duplicates(docs, width, percent).filter("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
