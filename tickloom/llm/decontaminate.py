"""Benchmark decontamination with a generalised suffix automaton of the test items.

The automaton reads words. It is built on the driver from a shard of the items with a stated bound on its words
and sent to the executors; where the items don't fit one shard the documents are read once per shard. Documents stream
through it: after each word it knows the longest suffix read that occurs in some item. Stretches of
words without any word pair of the items can't hold a window, and numpy skips them beforehand.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm import textkit

#: Consecutive words of an item that must occur; shorter items must occur whole.
WINDOW = 10
#: Words of items in one automaton, and so the bound on what is sent to an executor.
SHARD_WORDS = 200_000
#: Pipelines drop a document with a larger share of hit words.
COVERAGE = 0.5


class Automaton:
    """Suffix automaton of word sequences, with the items in which a state's words occur."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int = WINDOW):
        self.window = window
        self.ids: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        pairs, ends, short = set(), [], []
        items = [(name, [self.ids.setdefault(w, len(self.ids)) for w in words]) for name, words in items if words]
        for name, words in items:
            pairs.update(zip(words, words[1:]))
            state = 0
            for word in words:
                state = self._extend(state, word)
                ends.append((state, name))
            if len(words) < window:
                short.append((words, name))
        self.least = min([window, *(len(words) for words, _ in short)])
        self._spread(ends, short)
        names = pa.array(list(self.ids), pa.binary())
        hashes = textkit.Words(names, textkit.ALNUM).hashes
        order = np.argsort(hashes)
        self.hashes, self.codes = hashes[order], order.astype(np.int64)
        self.maybe = np.zeros(1 << 18, bool)
        self.maybe[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
        self.pairs = np.unique(np.array([a * len(self.ids) + b for a, b in pairs], np.int64))

    def _state(self, length: int, moves: dict[int, int], link: int) -> int:
        self.next.append(moves)
        self.length.append(length)
        self.link.append(link)
        return len(self.next) - 1

    def _split(self, at: int, word: int) -> int:
        """The state of the words of ``at`` and ``word`` exactly, taken out of a longer one if need be."""
        old = self.next[at][word]
        if self.length[old] == self.length[at] + 1:
            return old
        new = self._state(self.length[at] + 1, dict(self.next[old]), self.link[old])
        self.link[old] = new
        while at >= 0 and self.next[at].get(word) == old:
            self.next[at][word] = new
            at = self.link[at]
        return new

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, word)
        new = self._state(self.length[last] + 1, {}, 0)
        at = last
        while at >= 0 and word not in self.next[at]:
            self.next[at][word] = new
            at = self.link[at]
        if at >= 0:
            self.link[new] = self._split(at, word)
        return new

    def _spread(self, ends, short) -> None:
        """Items of each state from a window's length on, and the short items that end in a state."""
        self.items: dict[int, set[str]] = {}
        for state, name in ends:
            if self.length[state] >= self.window:
                self.items.setdefault(state, set()).add(name)
        for state in sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            if state in self.items and up > 0 and self.length[up] >= self.window:
                self.items.setdefault(up, set()).update(self.items[state])
        self.short: dict[int, list[tuple[int, str]]] = {}
        for words, name in short:
            state = 0
            for word in words:
                state = self.next[state][word]
            self.short.setdefault(state, []).append((len(words), name))

    def read(self, words: list[int], hit: np.ndarray, found: set[str]) -> None:
        """Marks the hit words of a stretch and adds the items that occur there."""
        state = length = 0
        for i, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if word in self.next[state]:
                state, length = self.next[state][word], length + 1
            else:
                length = 0
            if length >= self.window:
                at = state
                while self.length[self.link[at]] >= self.window:
                    at = self.link[at]
                hit[i - self.window + 1 : i + 1] = True
                found |= self.items[at]
            at = state if self.short else 0
            while at > 0:
                for n, name in self.short.get(at, ()):
                    if n <= length:
                        hit[i - n + 1 : i + 1] = True
                        found.add(name)
                at = self.link[at]

    def scan(self, column: pa.Array) -> tuple[textkit.Words, np.ndarray, dict[int, set[str]]]:
        """Words of a text column, which of them are hit, and the items that occur in each row that has any."""
        words = textkit.Words(column, textkit.ALNUM)
        hit, found = np.zeros(len(words), bool), {}
        code = np.full(len(words), -1, np.int64)
        maybe = np.flatnonzero(self.maybe[(words.hashes & np.uint64((1 << 18) - 1)).astype(np.int64)])
        if not len(maybe) or not len(self.hashes):
            return words, hit, found
        places = np.minimum(np.searchsorted(self.hashes, words.hashes[maybe]), len(self.hashes) - 1)
        known = self.hashes[places] == words.hashes[maybe]
        code[maybe[known]] = self.codes[places[known]]
        joined = (code[:-1] >= 0) & (code[1:] >= 0)
        first = words.first[1:-1]
        joined[first[(first > 0) & (first < len(words))] - 1] = False
        at = np.flatnonzero(joined)
        pair = code[at] * len(self.ids) + code[at + 1]
        if len(self.pairs):
            joined[at] = self.pairs[np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)] == pair
        else:
            joined[at] = False
        breaks = np.flatnonzero(~joined) + 1
        begins, ends = np.concatenate([[0], breaks]), np.concatenate([breaks, [len(words)]])
        keep = (ends - begins >= self.least) & (code[begins] >= 0)
        body = words.lowered
        for begin, end in zip(begins[keep].tolist(), ends[keep].tolist()):
            # By the bytes of the words, so a clash of hashes can't count as a hit.
            exact = [self.ids.get(body[a:b].tobytes(), -1) for a, b in zip(words.starts[begin:end], words.ends[begin:end])]
            row = int(np.searchsorted(words.first, begin, "right")) - 1
            new = set()
            self.read(exact, hit[begin:end], new)
            if new:
                found.setdefault(row, set()).update(new)
        return words, hit, found


def automata(items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS):
    """One automaton per shard of the items, each broadcast; there is one at least, if only of no items."""
    spark = items.sparkSession
    named = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("name"), F.coalesce("text", F.lit("")).alias("text"))
    total = named.agg(F.sum(F.octet_length("text") / 4)).first()[0] or 0
    shards = max(1, -(-int(total) // shard_words))
    placed = named.withColumn("shard", F.pmod(F.xxhash64("name", "text"), F.lit(shards)))
    for shard in range(shards):
        rows = placed.filter(F.col("shard") == shard).collect()
        split = []
        for row in rows:
            words = textkit.Words(pa.array([row["text"]]), textkit.ALNUM)
            split.append((row["name"], [words.lowered[a:b].tobytes() for a, b in zip(words.starts, words.ends)]))
        yield spark.sparkContext.broadcast(Automaton(split, window))


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def _scan(docs: DataFrame, automaton, text: str) -> DataFrame:
    kind = docs.schema["doc_id"].dataType.simpleString()
    out = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        machine = automaton.value
        for batch in batches:
            for part in textkit.slices(batch, "_text", textkit.SLICE):
                words, hit, found = machine.scan(part.column("_text"))
                n = np.diff(words.first)
                spans = [[] for _ in range(part.num_rows)]
                for row in found:
                    spans[row] = [{"start": a, "end": b} for a, b in _spans(hit[words.first[row] : words.first[row + 1]])]
                items = [sorted(found.get(row, ())) for row in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("_key"), pa.array(n, pa.int64()), pa.array(spans, out), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "_key", "n_words", "spans", "items"],
                )

    rows = docs.select("doc_id", F.xxhash64(text).alias("_key"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"doc_id {kind}, _key long, n_words long, spans array<struct<start:long,end:long>>, items array<string>")


def contamination(docs: DataFrame, items: DataFrame, text: str = "text", window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """Hit words and occurring items of each document: doc_id, n_words, spans, items, a row per input row.

    ``spans`` are maximal runs of hit words (from, to; counted from 0), ``items`` the sorted ids of the
    items of which some window occurs. Null and empty texts have no words and no hits; items without words match
    nothing; equal items are all named; a null item_id goes by the name ``null``. Other columns are not read.
    A very long text is followed whole, from its first word to its last. No ties arise: every window that occurs counts. Repeated documents are judged each; empty tables give no hits or no rows.
    """
    scans = [_scan(docs, a, text) for a in automata(items, window, shard_words)]
    whole = scans[0]
    if len(scans) == 1:
        return whole.drop("_key")
    more = _hits(scans[1:]).select("_doc", "_k", F.col("spans").alias("_spans"), F.col("items").alias("_items"))
    both = F.concat("spans", F.coalesce("_spans", F.array().cast(_SPANS)))
    joined = whole.join(more, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("_key") == F.col("_k")), "left")
    names = F.sort_array(F.array_distinct(F.concat("items", F.coalesce("_items", F.array().cast("array<string>")))))
    return joined.select("doc_id", "n_words", _merged(both).alias("spans"), names.alias("items"))


_SPANS = "array<struct<start:long,end:long>>"


def _hits(scans: list[DataFrame]) -> DataFrame:
    """_doc, _k (doc_id and hash of the text), spans, items of the documents that any of the scans hits; spans of two scans may overlap."""
    more = scans[0]
    for scan in scans[1:]:
        more = more.union(scan)
    return (
        more.filter(F.size("spans") > 0)
        .distinct()
        .groupBy(F.col("doc_id").alias("_doc"), F.col("_key").alias("_k"))
        .agg(F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items"))
    )


def _merged(spans: Column) -> Column:
    """Maximal runs of the words in any of the spans, in order."""
    return F.aggregate(
        F.sort_array(spans), F.array().cast(_SPANS),
        lambda out, x: F.when((F.size(out) > 0) & (F.element_at(out, -1).end >= x.start), F.concat(
            F.slice(out, 1, F.size(out) - 1),
            F.array(F.struct(F.element_at(out, -1).start.alias("start"), F.greatest(F.element_at(out, -1).end, x.end).alias("end"))),
        )).otherwise(F.concat(out, F.array(x))),
    )


def decontaminated(docs: DataFrame, items: DataFrame, text: str = "text", coverage: float = COVERAGE, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` without the hit spans; documents whose hit words exceed the coverage limit go.

    A span goes with what stands between its words, from its first word's first byte to its last one's last. All
    columns stay as they are but the text. Null texts stay null. Where the items make several shards, the spans of all
    are found in the whole texts first, and each text is judged and cut once.
    Nulls, very long texts, repeats and empty tables: as in contamination; other columns may have any name.
    """
    place, shards = docs.columns.index(text), list(automata(items, shard_words=shard_words))
    if len(shards) == 1:
        return docs.mapInArrow(_cleaner(shards[0], place, coverage), docs.schema)
    hits = _hits([_scan(docs, a, text) for a in shards]).select("_doc", "_k", _merged(F.col("spans")).alias("_spans"))
    rows = docs.join(hits, docs["doc_id"].eqNullSafe(hits["_doc"]) & (F.xxhash64(docs[text]) == hits["_k"]), "left")
    return rows.select(*[docs[c] for c in docs.columns], hits["_spans"]).mapInArrow(_cutter(place, coverage), docs.schema)


def _cut(part: pa.RecordBatch, place: int, words: textkit.Words, spans: dict[int, list[tuple[int, int]]], coverage: float) -> pa.RecordBatch:
    """The rows of ``part`` without their spans, and without the rows of which too much is hit."""
    keep, texts = np.ones(part.num_rows, bool), {}
    for row, found in spans.items():
        a, b = words.first[row], words.first[row + 1]
        if sum(end - begin for begin, end in found) > coverage * (b - a):
            keep[row] = False
            continue
        at, out = words.offsets[row], []
        for begin, end in found:
            out.append(words.data[at : words.starts[a + begin]].tobytes())
            at = words.ends[a + end - 1]
        texts[row] = b"".join([*out, words.data[at : words.offsets[row + 1]].tobytes()]).decode()
    if texts:
        column = part.column(place).to_pylist()
        for row, value in texts.items():
            column[row] = value
        part = part.set_column(place, part.schema.field(place), pa.array(column, part.schema.types[place]))
    return part.filter(pa.array(keep)) if not keep.all() else part


def _cleaner(automaton, place: int, coverage: float):
    """Finds the spans of the only shard and cuts them out."""

    def run(batches):
        machine = automaton.value
        for batch in batches:
            for part in textkit.slices(batch, batch.schema.names[place], textkit.SLICE):
                words, hit, found = machine.scan(part.column(place))
                spans = {row: _spans(hit[words.first[row] : words.first[row + 1]]) for row in found}
                yield _cut(part, place, words, spans, coverage)

    return run


def _cutter(place: int, coverage: float):
    """Cuts out the spans in the last column, null where there are none."""

    def run(batches):
        for batch in batches:
            for part in textkit.slices(batch, batch.schema.names[place], textkit.SLICE):
                lists = part.column(part.num_columns - 1).to_pylist()
                spans = {row: [(x["start"], x["end"]) for x in found] for row, found in enumerate(lists) if found}
                part = part.select(part.schema.names[:-1])
                yield _cut(part, place, textkit.Words(part.column(place), textkit.ALNUM), spans, coverage) if spans else part

    return run
