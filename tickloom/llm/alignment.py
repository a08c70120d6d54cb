"""Cross-tokenizer alignment: which tokens of two tokenizers cover the same bytes, counted over the corpus.

Byte offsets where tokens of both tokenizers end cut a text into groups; every token of one side in a group is linked with every
token of the other. An id pair's count is the number of documents that hold it linked.

External spill counting. A task reads a bounded piece of text and spills a *run*: pair-document records, sorted by pair
and radix-partitioned by the first side's id, as compressed rows of a table in the shared folder. Only the
pairs of a run and their document counts are then merged, FAN runs at a time with a k-way heap merge, up a tree of
stored levels, so that no task sees more than FAN lists however many runs there are and a pair that every document holds is one entry
a run. The last merge reads side-major: when the first side's id changes, its highest count is known. Counts and marks of the highest go
down the same tree in the order of each list, and meet the records of their run again, where they are
added up per document as the run's partitions stream by. Records never leave their run.

Documents travel as pieces between spaces: no token of either tokenizer reaches over a space that follows a
character other than white space, so each distinct piece is encoded and aligned once. Pieces are remembered by 64-bit hashes.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import stored

MARK = "▁"
#: Bytes of text in a run.
RUN_BYTES = 2 << 20
#: Radix partitions of a run, by the first side's id.
RADIX = 32
#: Lists merged at once.
FAN = 64
#: Pieces a worker remembers before it starts afresh.
REMEMBERED = 250_000
#: Pieces given to a tokenizer at once.
BATCH = 4096


def _zip(values: np.ndarray) -> bytes:
    return pa.compress(values.tobytes(), codec="zstd", asbytes=True) if len(values) else b""


def _unzip(body: bytes, n: int, kind) -> np.ndarray:
    size = n * np.dtype(kind).itemsize
    return np.frombuffer(pa.decompress(body, size, codec="zstd", asbytes=True), kind) if n else np.zeros(0, kind)


def _codes(body: bytes, n: int) -> np.ndarray:
    """Sorted codes from their differences."""
    return np.cumsum(_unzip(body, n, "<u4"), dtype=np.uint64).astype(np.int64)


class _Pieces(textkit.Words):
    """A space and each row's text, cut before spaces that follow another character than white space."""

    def __init__(self, column: pa.Array):
        self.data, self.offsets = textkit.text_bytes(pc.binary_join_element_wise(pa.scalar(" ", column.type), column, pa.scalar("", column.type)))
        data = self.data
        # Bytes that may end white space: all control characters, and the last two bytes of wider kinds.
        white = (data <= 0x20) | (data == 0x7F)
        if (data >= 0x80).any():
            a, b = data[:-1], data[1:]
            white[1:] |= (a == 0x80) | ((a == 0xC2) & ((b == 0x85) | (b == 0xA0))) | ((a == 0x9A) & (b == 0x80)) | ((a == 0x81) & (b == 0x9F)) | ((a == 0xA0) & (b == 0x8E))
        cut = data == 0x20
        cut[1:] &= ~white[:-1]
        cut[self.offsets[:-1][self.offsets[:-1] < self.offsets[1:]]] = True
        self.starts = np.flatnonzero(cut)
        self.ends = np.append(self.starts[1:], len(data))[: len(self.starts)]
        self.first = np.searchsorted(self.starts, self.offsets)
        self.hashes = self._hash(data)


def _byte_letters() -> dict[str, int]:
    """Bytes of a byte-level vocabulary's letters: printable bytes stand for themselves, the others for 256, 257, ..."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(other)}


#: Links of a group up to which each pair of its tokens is made; beyond, pairs of its distinct ids.
FEW_LINKS = 4096


class _Side:
    """Tokens of one tokenizer: their bytes one after the other, and how an id is written before each separator."""

    def __init__(self, spelled: list[bytes], within: str, last: str):
        self.sizes = np.array(list(map(len, spelled)), np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.bytes = np.frombuffer(b"".join(spelled), np.uint8)
        self.within, self.last = (np.array([f"{i}{mark}" for i in range(len(spelled))], object) for mark in (within, last))

    def spell(self, ids: np.ndarray) -> np.ndarray:
        return self.bytes[textkit.ragged(self.starts[ids], self.sizes[ids])]


class _Tokens:
    """A side's ids of many pieces, one piece after the other."""

    def __init__(self, side: _Side, lists: list[list[int]]):
        self.side = side
        counts = np.array(list(map(len, lists)), np.int64)
        self.ids = np.fromiter(itertools.chain.from_iterable(lists), np.int64, int(counts.sum()))
        self.piece = np.repeat(np.arange(len(lists)), counts)

    def lengths(self, n: int) -> np.ndarray:
        return np.bincount(self.piece, self.side.sizes[self.ids], n).astype(np.int64)

    def only(self, good: np.ndarray) -> None:
        keep = good[self.piece]
        self.ids, self.piece = self.ids[keep], self.piece[keep]

    def grouped(self, ends: np.ndarray, common: np.ndarray) -> None:
        """Group of each token, and each group's first token and their number."""
        self.group = np.searchsorted(common, ends)
        self.n = np.bincount(self.group, minlength=len(common))
        self.first = np.cumsum(self.n) - self.n

    def written(self) -> np.ndarray:
        """Each id with the separator behind it."""
        ends = np.arange(len(self.ids)) == self.first[self.group] + self.n[self.group] - 1
        return np.where(ends, self.side.last[self.ids], self.side.within[self.ids])


class Aligner:
    """Aligned pieces for a byte-level BPE file (A) and a sentencepiece model with byte fallback (B)."""

    def __init__(self, a_path: str, b_path: str):
        import json

        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        made = json.loads(self.a.to_str())
        if made["normalizer"] or made["pre_tokenizer"] != {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}:
            raise ValueError("the first tokenizer must be a byte-level BPE that cuts before spaces")
        letters = _byte_letters()
        spelled = self.a.get_vocab()
        a_bytes = [b""] * (max(spelled.values()) + 1)
        for word, i in spelled.items():
            a_bytes[i] = bytes(map(letters.get, word)) if all(c in letters for c in word) else b""
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any(MARK in p.lstrip(MARK) for p in pieces) or self.b.decode(self.b.encode("  a ")) != "  a " or self.b.encode("a", out_type=str)[0][:1] != MARK:
            raise ValueError("the second tokenizer must keep spaces, add one in front, and have none inside a piece")
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(MARK, " ").encode() for i, p in enumerate(pieces)]
        self.space = self.b.piece_to_id(MARK)
        self.a_side, self.b_side = _Side(a_bytes, ",", "|"), _Side(b_bytes, ",", ";")
        self.n_b = len(b_bytes)
        # A pair's code puts the first side's ids of a radix partition next to each other.
        self.per_radix = -(-len(a_bytes) // RADIX)
        if self.per_radix * RADIX * self.n_b >= 1 << 32:
            raise ValueError("vocabularies too large for 32-bit pair codes")
        self._forget()

    def _forget(self) -> None:
        self.known: dict[int, int] = {}
        self.strings: list[str] = []
        #: n_a, n_b, n_groups, n_links, whether the bytes of all three are the same.
        self.facts = np.zeros((0, 5), np.int64)
        self.pairs, self.times = np.zeros(0, np.uint32), np.zeros(0, np.int64)
        self.starts, self.sizes = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def code(self, a, b):
        return ((a % RADIX) * self.per_radix + a // RADIX) * self.n_b + b

    def _encoded(self, pieces: list[bytes]) -> tuple[_Tokens, _Tokens]:
        firsts, seconds = [], []
        for at in range(0, len(pieces), BATCH):
            texts = [p.decode() for p in pieces[at : at + BATCH]]
            firsts += [found.ids for found in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            # The library puts a space in front by itself; a lone space is a token.
            seconds += [ids if len(t) > 1 else [self.space] for t, ids in zip(texts, self.b.encode([t[1:] for t in texts], num_threads=1))]
        return _Tokens(self.a_side, firsts), _Tokens(self.b_side, seconds)

    def _learn(self, hashes: list[int], pieces: list[bytes]) -> None:
        n, sizes = len(pieces), np.array(list(map(len, pieces)), np.int64)
        a, b = self._encoded(pieces)
        good = (a.lengths(n) == sizes) & (b.lengths(n) == sizes)
        body = np.frombuffer(b"".join(itertools.compress(pieces, good.tolist())), np.uint8)
        a.only(good)
        b.only(good)
        wrong = (self.a_side.spell(a.ids) != body) | (self.b_side.spell(b.ids) != body)
        if wrong.any():
            good[np.repeat(np.flatnonzero(good), sizes[good])[wrong]] = False
            a.only(good)
            b.only(good)
        # Both sides cover the same bytes, so their ends can be compared over all pieces at once.
        ends = [np.cumsum(side.side.sizes[side.ids]) for side in (a, b)]
        common = np.intersect1d(*ends, assume_unique=True)
        a.grouped(ends[0], common)
        b.grouped(ends[1], common)
        where = a.piece[a.first]
        links = a.n * b.n
        facts = np.zeros((n, 5), np.int64)
        for column, (piece, times) in enumerate([(a.piece, None), (b.piece, None), (where, None), (where, links)]):
            facts[:, column] = np.bincount(piece, times, n)
        facts[:, 4] = good
        # Pairs of a piece with the times they are linked.
        some = links[a.group] <= FEW_LINKS
        group, many = a.group[some], b.n[a.group[some]]
        codes = [self.code(np.repeat(a.ids[some], many), b.ids[textkit.ragged(b.first[group], many)])]
        owners, times = [np.repeat(a.piece[some], many)], [np.ones(int(many.sum()), np.int64)]
        for g in np.flatnonzero(links > FEW_LINKS).tolist():
            (i, x), (j, y) = (np.unique(side.ids[side.first[g] : side.first[g] + side.n[g]], return_counts=True) for side in (a, b))
            codes.append(self.code(i[:, None], j).ravel())
            owners.append(np.full(len(i) * len(j), where[g]))
            times.append(np.outer(x, y).ravel())
        both = np.concatenate(owners) << 32 | np.concatenate(codes)
        order = np.argsort(both, kind="stable")
        first = np.flatnonzero(np.append(True, np.diff(both[order]) != 0)) if len(both) else np.zeros(0, np.int64)
        pairs = both[order][first]
        sums = np.add.reduceat(np.concatenate(times)[order], first) if len(first) else np.zeros(0, np.int64)
        # Groups as text: the ids of both sides, group after group.
        written = np.empty(len(a.ids) + len(b.ids), object)
        written[np.arange(len(a.ids)) + b.first[a.group]] = a.written()
        written[np.arange(len(b.ids)) + (a.first + a.n)[b.group]] = b.written()
        written, cuts = written.tolist(), np.concatenate([[0], np.cumsum(facts[:, 0] + facts[:, 1])]).tolist()
        self.strings += ["".join(written[i:j]) for i, j in itertools.pairwise(cuts)]

        self.known.update(zip(hashes, range(len(self.facts), len(self.facts) + n)))
        held = np.bincount(pairs >> 32, minlength=n)
        self.starts = np.concatenate([self.starts, len(self.pairs) + np.cumsum(held) - held])
        self.sizes = np.concatenate([self.sizes, held])
        self.facts = np.concatenate([self.facts, facts])
        self.pairs = np.concatenate([self.pairs, (pairs & 0xFFFFFFFF).astype(np.uint32)])
        self.times = np.concatenate([self.times, sums])

    def _look_up(self, pieces: _Pieces) -> np.ndarray:
        """Place of each piece among the remembered ones."""
        if len(self.known) > REMEMBERED:
            self._forget()
        hashes, example, inverse = np.unique(pieces.hashes, return_index=True, return_inverse=True)
        hashes = hashes.tolist()
        new = [k for k, h in enumerate(hashes) if h not in self.known]
        if new:
            at = example[new]
            spelled = [pieces.data[a:b].tobytes() for a, b in zip(pieces.starts[at].tolist(), pieces.ends[at].tolist())]
            self._learn([hashes[k] for k in new], spelled)
        return np.array([self.known[h] for h in hashes], np.int64)[inverse]

    def run(self, column: pa.Array):
        """Digest columns of each row, and the run's records: (codes, documents of each, rows, times), rows and times by code."""
        pieces = _Pieces(column)
        place = self._look_up(pieces)
        sums = np.zeros((len(place) + 1, 5), np.int64)
        np.cumsum(self.facts[place], axis=0, out=sums[1:])
        facts = sums[pieces.first[1:]] - sums[pieces.first[:-1]]
        counts = np.diff(pieces.first)
        whole = (facts[:, 4] == counts) & (np.diff(pieces.offsets) > 1)  # a lone space stands for an empty text
        facts[~whole] = 0
        digests = []
        for good, a, b in zip(whole.tolist(), pieces.first[:-1].tolist(), pieces.first[1:].tolist()):
            text = "".join([self.strings[k] for k in place[a:b].tolist()])[:-1] if good else ""
            digests.append(hashlib.sha256(text.encode()).hexdigest() if good else "")
        # Distinct pieces of each row, then distinct pairs of each row.
        rows = pieces.rows()
        used = whole[rows]
        both, n = np.unique(rows[used] << 32 | place[used], return_counts=True)
        row, piece = both >> 32, both & 0xFFFFFFFF
        size = self.sizes[piece]
        at = textkit.ragged(self.starts[piece], size)
        key = self.pairs[at].astype(np.uint64) << np.uint64(32) | np.repeat(row, size).astype(np.uint64)
        times = np.repeat(n, size) * self.times[at]
        order = np.argsort(key, kind="stable")
        key, times = key[order], times[order]
        first = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
        key, times = key[first], np.add.reduceat(times, first) if len(first) else times
        codes, documents = np.unique(key >> np.uint64(32), return_counts=True)
        return facts[:, :4], digests, codes.astype(np.int64), documents, (key & np.uint64(0xFFFFFFFF)).astype(np.int64), times


@functools.cache
def aligner_of(a_path: str, b_path: str) -> Aligner:
    """The worker's aligner, kept with its pieces from task to task."""
    return Aligner(a_path, b_path)


RUNS = "node long, radix int, n int, codes binary, documents binary, m int, records binary"
_RUNS = pa.schema([("node", pa.int64()), ("radix", pa.int32()), ("n", pa.int32()), ("codes", pa.binary()), ("documents", pa.binary()), ("m", pa.int32()), ("records", pa.binary())])
#: Partition of a run that holds its documents' own columns.
HEAD = -1


def _packed(node: int, radix: int, codes: np.ndarray, counts: np.ndarray, rows=None, times=None) -> dict:
    out = {"node": node, "radix": radix, "n": len(codes), "codes": _zip(np.diff(codes, prepend=0).astype("<u4")), "documents": _zip(counts.astype("<i8"))}
    if rows is not None:
        out |= {"m": len(rows), "records": _zip(np.concatenate([rows, times]).astype("<i8"))}
    return out


def _head(node: int, doc_ids: pa.Array, facts: np.ndarray, digests: list[str]) -> dict:
    table = pa.table([doc_ids, *(pa.array(c) for c in facts.T), pa.array(digests, pa.string())], ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_table(table)
    return {"node": node, "radix": HEAD, "n": len(doc_ids), "codes": b"", "documents": b"", "m": 0, "records": sink.getvalue().to_pybytes()}


def spilled_runs(docs: DataFrame, a_path: str, b_path: str, text: str = "text", run_bytes: int = RUN_BYTES) -> DataFrame:
    """RUNS rows: for each run a head row and a row for each radix partition with pairs."""

    def spill(batches):
        aligner, sequence = aligner_of(a_path, b_path), itertools.count()
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in textkit.slices(batch, "text", run_bytes):
                node = task | next(sequence)
                facts, digests, codes, documents, rows, times = aligner.run(part.column("text"))
                yield pa.RecordBatch.from_pylist([_head(node, part.column("doc_id"), facts, digests)], _RUNS)
                ends = np.concatenate([[0], np.cumsum(documents)])
                cuts = np.searchsorted(codes, np.arange(RADIX + 1) * (aligner.per_radix * aligner.n_b))
                out = [
                    _packed(node, radix, codes[a:b], documents[a:b], rows[ends[a] : ends[b]], times[ends[a] : ends[b]])
                    for radix, (a, b) in enumerate(itertools.pairwise(cuts.tolist()))
                    if a < b
                ]
                yield pa.RecordBatch.from_pylist(out, _RUNS)

    return docs.select("doc_id", F.col(text).alias("text")).mapInArrow(spill, RUNS)


LIST = "node long, radix int, n int, codes binary, documents binary"
_LIST = pa.schema([_RUNS.field(name) for name in ("node", "radix", "n", "codes", "documents")])
ANSWER = "node long, radix int, totals binary, best binary"
_ANSWER = pa.schema([("node", pa.int64()), ("radix", pa.int32()), ("totals", pa.binary()), ("best", pa.binary())])


def _lists(table: pa.Table):
    """(row's columns, codes, counts) of LIST rows."""
    for row in table.select(_LIST.names).to_pylist():
        yield row, _codes(row["codes"], row["n"]), _unzip(row["documents"], row["n"], "<i8")


def heap_merged(lists: list[tuple[np.ndarray, np.ndarray]]):
    """(code, sum of its counts) in ascending order, from sorted (codes, counts), by a k-way heap merge."""
    merged = heapq.merge(*(zip(codes.tolist(), counts.tolist()) for codes, counts in lists))
    for code, same in itertools.groupby(merged, key=lambda entry: entry[0]):
        yield code, sum(count for _, count in same)


def _merge(table: pa.Table) -> pa.Table:
    lists = [(codes, counts) for _, codes, counts in _lists(table)]
    merged = np.array(list(heap_merged(lists)), np.int64).reshape(-1, 2)
    out = _packed(table["parent"][0].as_py(), table["radix"][0].as_py(), merged[:, 0], merged[:, 1])
    return pa.Table.from_pylist([out], _LIST)


def _bests(table: pa.Table, n_b: int) -> pa.Table:
    """Answers of a list of all counts, read side-major: an id's pairs are marked once the next id begins."""
    out = []
    for row, codes, counts in _lists(table):
        best = np.zeros(len(codes), bool)
        at = np.flatnonzero(np.append(True, codes[1:] // n_b != codes[:-1] // n_b)) if len(codes) else np.zeros(0, np.int64)
        if len(at):
            best = counts == np.repeat(np.maximum.reduceat(counts, at), np.diff(np.append(at, len(codes))))
        out.append({"node": row["node"], "radix": row["radix"], "totals": _zip(counts), "best": np.packbits(best).tobytes()})
    return pa.Table.from_pylist(out, _ANSWER)


def _handed_down(children: pa.Table, parents: pa.Table) -> pa.Table:
    """Answers of the children's lists from their parent's list and answer."""
    if not children.num_rows:
        return _ANSWER.empty_table()
    (parent,) = parents.to_pylist()
    known = _codes(parent["codes"], parent["n"])
    totals = _unzip(parent["totals"], parent["n"], "<i8")
    best = np.unpackbits(np.frombuffer(parent["best"], np.uint8), count=parent["n"])
    out = []
    for row, codes, _ in _lists(children):
        at = np.searchsorted(known, codes)
        out.append({"node": row["node"], "radix": row["radix"], "totals": _zip(totals[at]), "best": np.packbits(best[at]).tobytes()})
    return pa.Table.from_pylist(out, _ANSWER)


def pair_counts(lists: DataFrame, n_runs: int, n_b: int, fan: int = FAN) -> DataFrame:
    """ANSWER rows for the LIST rows of all runs: corpus-wide counts of the codes, in order, and marks of the highest of each first id."""
    keys = ["parent", "radix"]
    wide = max(1, -(-n_runs // fan))
    # Runs are dealt by a hash of their number, further levels by place; the last level has one list a partition.
    levels, parents = [lists], [F.pmod(F.xxhash64("node"), F.lit(wide)) if n_runs > 1 else F.lit(0).cast("long")]
    while True:
        below = levels[-1].withColumn("parent", parents[-1])
        merged = below.repartition(max(8, wide * RADIX // 8), *keys).groupBy(*keys).applyInArrow(_merge, LIST)
        levels.append(stored(merged, "pair-counts"))
        if wide == 1:
            break
        wide = -(-wide // fan)
        parents.append(F.floor(F.col("node") / fan).cast("long"))

    answers = stored(levels[-1].groupBy("node", "radix").applyInArrow(lambda t: _bests(t, n_b), ANSWER), "pair-answers")
    for level in range(len(levels) - 2, -1, -1):
        above = levels[level + 1].join(answers, ["node", "radix"]).withColumnRenamed("node", "parent")
        children = levels[level].withColumn("parent", parents[level])
        answers = stored(children.groupBy(*keys).cogroup(above.groupBy(*keys)).applyInArrow(_handed_down, ANSWER), "pair-answers")
    return answers


def _summed(runs: pa.Table, answers: pa.Table) -> pa.Table:
    """Documents of a run with their own columns and the sums over their links."""
    rows = {row["radix"]: row for row in runs.to_pylist()}
    head = rows.pop(HEAD)
    table = pa.ipc.open_stream(head["records"]).read_all()
    count_sum, n_best = np.zeros(head["n"], np.int64), np.zeros(head["n"], np.int64)
    for answer in answers.to_pylist():
        row = rows[answer["radix"]]
        documents = _unzip(row["documents"], row["n"], "<i8")
        at, times = _unzip(row["records"], 2 * row["m"], "<i8").reshape(2, -1)
        totals = np.repeat(_unzip(answer["totals"], row["n"], "<i8"), documents)
        best = np.repeat(np.unpackbits(np.frombuffer(answer["best"], np.uint8), count=row["n"]), documents)
        np.add.at(count_sum, at, times * totals)
        np.add.at(n_best, at, times * best)
    return table.append_column("n_best", pa.array(n_best)).append_column("count_sum", pa.array(count_sum))


def aligned(docs: DataFrame, a_path: str, b_path: str, text: str = "text", run_bytes: int = RUN_BYTES, fan: int = FAN) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 for each row.

    Null and empty texts, and texts whose tokens don't spell a space and the text in bytes (as with U+2581 inside), have no tokens: zeros
    and an empty groups_sha256. Repeated rows are documents of their own and count each. Of an id's pairs with equal counts
    all are the highest. doc_id is only carried along; other columns are not read. A text longer than a run's bytes is a run of its own;
    it is in memory whole, with its records. An empty table gives no rows.
    """
    runs = stored(spilled_runs(docs, a_path, b_path, text, run_bytes), "pair-runs")
    n_runs = runs.filter(F.col("radix") == HEAD).count()
    n_b = aligner_of(a_path, b_path).n_b
    answers = pair_counts(runs.filter(F.col("radix") != HEAD).select(*_LIST.names), n_runs, n_b, fan)
    kind = docs.schema["doc_id"].dataType.simpleString()
    columns = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, n_best long, count_sum long"
    parts = max(8, n_runs // 2)
    whole = runs.repartition(parts, "node").groupBy("node").cogroup(answers.repartition(parts, "node").groupBy("node"))
    return whole.applyInArrow(_summed, columns)
