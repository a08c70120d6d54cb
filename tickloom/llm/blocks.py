"""Finding keys that documents share, in two exchanges of packed keys.

Documents are dealt into blocks of bounded size. A block names its distinct keys (64-bit hashes, in
order) to the buckets of the key space, five bytes of hash and a byte of counts each; a bucket merges the
lists and answers each block with two bits a key: does another document hold it, and is it
common. The answer goes back in the order of the block's keys, so keys travel once and never come back. A key that
a third of all documents hold is one entry per block. Cut-off hashes can only make a key look shared
that isn't, which costs a later exact look.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import pieces

#: Bytes of text in a block.
BLOCK_BYTES = 1 << 20
#: Bytes of a key's hash that are sent, after the bits that name its bucket.
KEPT = 5
SHARED, COMMON = 1, 2
REPLY = "block long, kind int, bucket long, bits binary"
REPLY_FIELDS = ["block", "kind", "bucket", "bits"]
_TYPES = [pa.int64(), pa.int32(), pa.int64(), pa.binary()]


def blocked(docs: DataFrame, total_bytes: int, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """block, ids, lengths, body: rows dealt by a hash of their content, the same at every reading.

    The rows of a batch that go to one block travel as one: their doc_ids (long), the bytes of each text, -1 for null, and the
    texts joined and compressed. ``unpacked`` gives the rows of a block back.
    """
    n = pieces(total_bytes, block_bytes)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).alias("block"), "doc_id", "text")

    def pack(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch]).sort_by("block")
            block = table.column("block").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), len(block)] if len(block) else [0]
            out = []
            for a, b in zip(cuts, cuts[1:]):
                part = table.slice(a, b - a)
                data, offsets = textkit.text_bytes(part.column("text"))
                lengths = np.where(part.column("text").is_null().to_numpy(), -1, np.diff(offsets))
                body = pa.compress(data.tobytes(), codec="zstd", asbytes=True)
                out.append((int(block[a]), part.column("doc_id").to_pylist(), lengths, body))
            blocks, ids, lengths, bodies = zip(*out) if out else [[]] * 4
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(blocks, pa.int64()), pa.array(ids, longs), pa.array(lengths, longs), pa.array(bodies, pa.binary())],
                ["block", "ids", "lengths", "body"],
            )

    packed = rows.mapInArrow(pack, "block long, ids array<long>, lengths array<long>, body binary")
    # Several blocks to a partition, so that the number of blocks may differ from that of tasks.
    return packed.repartition(max(8, n // 8), "block")


def unpacked(table: pa.Table) -> pa.Table:
    """block, doc_id, text of the rows of a block."""
    ids = pa.concat_arrays([c.flatten() for c in table.column("ids").chunks]) if table.num_rows else pa.array([], pa.int64())
    lengths = np.concatenate([np.zeros(0, np.int64), *[c.flatten().to_numpy() for c in table.column("lengths").chunks]])
    sizes = [int(np.maximum(x, 0).sum()) for x in table.column("lengths").to_pylist()]
    bodies = [pa.decompress(b, n, codec="zstd", asbytes=True) if n else b"" for b, n in zip(table.column("body").to_pylist(), sizes)]
    ends = np.concatenate([[0], np.cumsum(np.maximum(lengths, 0))])
    valid = pa.array(lengths >= 0)
    buffers = [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(b"".join(bodies))]
    text = pa.Array.from_buffers(pa.large_string(), len(lengths), buffers)
    text = pc.if_else(valid, text, pa.scalar(None, pa.large_string()))
    block = table.column("block")[0].as_py() if table.num_rows else 0
    return pa.table({"block": pa.array([block] * len(lengths), pa.int64()), "doc_id": ids, "text": text})


def key_bits(total_bytes: int, bytes_per_key: int, keys_per_bucket: int = 1 << 18) -> int:
    """Leading bits of a hash that name its bucket: buckets grow with the text."""
    return max(5, (max(1, total_bytes // bytes_per_key // keys_per_bucket) - 1).bit_length())


def first_of(doc_ids: pa.Array) -> np.ndarray:
    """doc_ids as integers to compare by; a null comes after all others."""
    return doc_ids.fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


class Keys:
    """Distinct keys of a block: sorted ``hashes``, the ``inverse`` of each occurrence, first and last document."""

    def __init__(self, hashes: np.ndarray, docs: np.ndarray):
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        new = np.ones(len(ranked), bool)
        new[1:] = ranked[1:] != ranked[:-1]
        at = np.flatnonzero(new)
        self.hashes = ranked[at]
        self.inverse = np.empty(len(ranked), np.int64)
        self.inverse[order] = np.cumsum(new) - 1
        self.example = order[at] if len(at) else at
        self.counts = np.diff(np.append(at, len(ranked)))
        ids = docs[order]
        self.first = np.minimum.reduceat(ids, at) if len(at) else ids
        self.last = np.maximum.reduceat(ids, at) if len(at) else ids

    def named(self, bits: int):
        """(bucket, packed keys) for each bucket that has some."""
        note = np.minimum(self.counts, 127).astype(np.uint8) | ((self.first < self.last).astype(np.uint8) << 7)
        rest = ((self.hashes << np.uint64(bits)) >> np.uint64(64 - 8 * KEPT)).astype("<u8")
        packed = np.empty((len(rest), KEPT + 1), np.uint8)
        packed[:, :KEPT] = rest.view(np.uint8).reshape(-1, 8)[:, :KEPT]
        packed[:, KEPT] = note
        for bucket, a, b in self._buckets(bits):
            yield bucket, packed[a:b].tobytes()

    def _buckets(self, bits: int):
        of = (self.hashes >> np.uint64(64 - bits)).astype(np.int64)
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(of)) + 1, [len(of)]]) if len(of) else np.zeros(1, np.int64)
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            yield int(of[a]), a, b

    def codes(self, bits: int, replies: dict[int, bytes]) -> np.ndarray:
        """The answer to each key: 0, SHARED, or SHARED | COMMON."""
        out = np.zeros(len(self.hashes), np.uint8)
        for bucket, a, b in self._buckets(bits):
            flat = np.unpackbits(np.frombuffer(replies[bucket], np.uint8), count=2 * (b - a), bitorder="little")
            out[a:b] = flat[: b - a] * SHARED + flat[b - a :] * COMMON
        return out


def shared_keys(blocks: DataFrame, keys_of, bits: int, common: int, kind: int = 1) -> DataFrame:
    """Answers for the keys of every block, as rows of REPLY.

    ``keys_of`` maps a block's Arrow table to Keys. A key is shared if two documents hold it, common if more than ``common``
    occurrences do (each block counts to 127).
    """

    def name(table: pa.Table) -> pa.Table:
        rows = list(keys_of(table).named(bits))
        block = table.column("block")[0].as_py() if table.num_rows else 0
        return pa.table({"bucket": pa.array([b for b, _ in rows], pa.int64()), "block": pa.array([block] * len(rows), pa.int64()),
                         "keys": pa.array([k for _, k in rows], pa.binary())})

    def merge(table: pa.Table) -> pa.Table:
        lists = [np.frombuffer(x, np.uint8).reshape(-1, KEPT + 1) for x in table.column("keys").to_pylist()]
        packed = np.concatenate(lists)
        wide = np.zeros((len(packed), 8), np.uint8)
        wide[:, :KEPT] = packed[:, :KEPT]
        hashes = wide.view("<u8").ravel()
        order = np.argsort(hashes, kind="stable")
        ranked = hashes[order]
        at = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        size = np.diff(np.append(at, len(ranked)))
        note = packed[order, KEPT]
        shared = (size > 1) | np.logical_or.reduceat(note >= 128, at)
        many = np.add.reduceat((note & 127).astype(np.int64), at) > common
        of = np.empty(len(order), np.int64)
        of[order] = np.repeat(np.arange(len(at)), size)
        out, start = [], 0
        for part in lists:
            mine = of[start : start + len(part)]
            out.append(np.packbits(np.concatenate([shared[mine], (shared & many)[mine]]), bitorder="little").tobytes())
            start += len(part)
        return replies(table.column("block").to_pylist(), kind, table.column("bucket").to_pylist(), out)

    named = blocks.groupBy("block").applyInArrow(name, "bucket long, block long, keys binary")
    return named.groupBy("bucket").applyInArrow(merge, REPLY)


def replies(blocks: list, kind: int, buckets: list, bits: list[bytes]) -> pa.Table:
    columns = [blocks, [kind] * len(blocks), buckets, bits]
    return pa.table([pa.array(c, t) for c, t in zip(columns, _TYPES)], REPLY_FIELDS)


def by_bucket(table: pa.Table, kind: int) -> dict[int, bytes]:
    rows = zip(*(table.column(c).to_pylist() for c in ("kind", "bucket", "bits")))
    return {bucket: bits for k, bucket, bits in rows if k == kind}
