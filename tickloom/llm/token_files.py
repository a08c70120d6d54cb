"""Token-id files: concatenated ids with Elias-Fano coded document boundaries.

Format. A folder of Parquet files, written and committed by Spark, so it works on any store Spark
writes to and survives lost executors. A row is a chunk of consecutive documents in ascending order:

    part, seq   the range of doc_ids the chunk belongs to, and its place there; (part, seq) orders chunks
    doc_ids     array<bigint>, one per document
    width       bytes of an id, 2 or 4, little endian
    ids         all ids of the chunk, document after document, each ended by the end id
    n_ids       their number
    low, high   Elias-Fano code of the document ends, as a non-decreasing sequence up to n_ids
    low_bits    bits of each entry of ``low``
    marks       u32 positions of every 64th set bit of ``high``, for select

With m documents and n ids the code takes about 2 + log2(n / m) bits a document. ``select(i)`` finds the
end of document i from a mark and at most 64 further set bits, without a table of 64-bit offsets.
"""

from __future__ import annotations

import functools
import string
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickloom.llm import textkit
from tickloom.llm.common import pieces, stored, text_bytes

#: Ids after which a chunk ends; a longer document is a chunk of its own.
CHUNK_IDS = 1 << 20
#: Bytes of text in one sorted range.
RANGE_BYTES = 16 << 20
#: Words whose ids a worker remembers before it starts afresh.
REMEMBERED = 1_000_000
#: Words of letters encoded as one text.
TOGETHER = 200
#: Places of the table that finds a remembered word by the last bits of its hash.
SLOTS = 1 << 21
#: ASCII punctuation that starts none of the pre-tokens which begin with an apostrophe; letters and digits it may follow.
_STOPS = np.isin(np.arange(256), [ord(c) for c in string.punctuation if c != "'"])
_PLAIN_LETTER = np.isin(np.arange(256), [ord(c) for c in string.ascii_letters + string.digits])
EVERY = 64


class EliasFano:
    """A non-decreasing sequence of integers in about 2 + log2(universe / length) bits each."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, marks: bytes):
        self.n, self.low_bits = n, low_bits
        self.low, self.high = np.frombuffer(low, np.uint8), np.frombuffer(high, np.uint8)
        self.marks = np.frombuffer(marks, "<u4")

    @classmethod
    def of(cls, values) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = (values[:, None] >> np.arange(low_bits, dtype=np.uint64)) & np.uint64(1)
        ones = (values >> np.uint64(low_bits)).astype(np.int64) + np.arange(n)
        high = np.zeros(ones[-1] + 1 if n else 0, np.uint8)
        high[ones] = 1
        pack = lambda b: np.packbits(b, bitorder="little").tobytes()
        return cls(n, low_bits, pack(bits.astype(np.uint8).ravel()), pack(high), ones[::EVERY].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """Value i, from one mark and the bits behind it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self.marks[i // EVERY])
        left, byte = i % EVERY, at // 8
        word = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (ones := word.bit_count()) <= left:
            left -= ones
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = byte * 8 + (word & -word).bit_length() - 1
        low = 0
        if self.low_bits:
            start = i * self.low_bits
            span = self.low[start // 8 : (start + self.low_bits + 7) // 8].tobytes()
            low = (int.from_bytes(span, "little") >> (start % 8)) & ((1 << self.low_bits) - 1)
        return (place - i) << self.low_bits | low

    def values(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[: self.n]
        out = (ones - np.arange(self.n)).astype(np.int64) << self.low_bits
        if self.low_bits and self.n:
            bits = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
            out |= bits.astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return out


CHUNK = (
    "part long, seq long, doc_ids array<bigint>, width int, ids binary, n_ids long, "
    "low_bits int, low binary, high binary, marks binary"
)
_ARROW = pa.schema(
    [("part", pa.int64()), ("seq", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("width", pa.int32()), ("ids", pa.binary()),
     ("n_ids", pa.int64()), ("low_bits", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("marks", pa.binary())]
)


class _Parts(textkit.Words):
    """Words without white space, cut before punctuation behind a letter or digit, where pre-tokens end in any case.

    Letters A to Z are folded. Texts with a special string's mark or with marks that the normaliser may compose with a
    letter before it folds its case are left as they are.
    """

    def __init__(self, column: pa.Array):
        data, _ = textkit.text_bytes(column)
        marks = (data == 0xCC) | (data == 0xCD)
        self.as_is = bool(marks.any() or ((data[:-1] == 0x3C) & (data[1:] == 0x7C)).any())
        super().__init__(column, textkit.PLAIN, lower=not self.as_is)

    def _cut(self, starts, ends):
        if self.as_is or not len(starts):
            return starts, ends
        bare = np.where(_STOPS[self.lowered], -1, np.arange(len(self.lowered)))
        bare = np.maximum.accumulate(bare)[ends - 1]
        cut = (bare >= starts) & (bare < ends - 1) & _PLAIN_LETTER[self.lowered[np.maximum(bare, 0)]]
        places = np.flatnonzero(cut)
        return np.insert(starts, places + 1, bare[places] + 1), np.insert(ends, places, bare[places] + 1)


class WordEncoder:
    """Ids of texts for a tokenizer that folds case, drops white space and splits there.

    The library encodes each distinct word once; a text's ids are those of its words. That equals encoding the whole
    text, because neither the normaliser, nor the special strings, nor the pre-tokens of such a
    tokenizer reach over the places where words are cut. Words of letters are one pre-token each, so many are encoded
    as one text and told apart by the mark of a word's last id. Words are remembered by 64-bit hashes, each in the one
    place that its last bits name: a word that another one put out of its place is encoded again when it is next met.
    So what is remembered takes arrays of bounded size and no object per word.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.library = Tokenizer.from_file(path)
        # To words of the letters a to z the normaliser and the byte alphabet do nothing.
        self.plain = Tokenizer(self.library.model)
        self.plain.pre_tokenizer = WhitespaceSplit()
        vocabulary = self.library.get_vocab()
        self.width = 2 if len(vocabulary) <= 1 << 16 else 4
        self.kind = f"<u{self.width}"
        self.last = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        self.last[[i for word, i in vocabulary.items() if word.endswith("</w>")]] = True
        self._forget()

    def _forget(self) -> None:
        self.slot_hash, self.slot_code = np.zeros(SLOTS, np.uint64), np.zeros(SLOTS, np.int64)
        self.ids, self.starts, self.sizes = np.zeros(0, self.kind), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def _one_by_one(self, words: list[str]):
        """(ids, sizes) of words encoded one by one."""
        for at in range(0, len(words), TOGETHER):
            found = [x.ids for x in self.library.encode_batch_fast(words[at : at + TOGETHER], add_special_tokens=False)]
            yield np.array([i for ids in found for i in ids], self.kind), np.array([len(ids) for ids in found], np.int64)

    def _letters(self, library, words: list[str]):
        """(ids, sizes) of words of letters, many at once."""
        for at in range(0, len(words), TOGETHER):
            part = words[at : at + TOGETHER]
            (found,) = library.encode_batch_fast([" ".join(part)], add_special_tokens=False)
            ids = np.array(found.ids, self.kind)
            ends = np.flatnonzero(self.last[ids]) + 1
            if len(ends) == len(part) and ends[-1] == len(ids):
                yield ids, np.diff(ends, prepend=0)
            else:
                yield from self._one_by_one(part)

    def _learn(self, words: list[str]) -> np.ndarray:
        """Codes of words whose ids are now remembered."""
        plain, letters, rest = [], [], []
        for k, word in enumerate(words):
            (rest if not word.isalpha() else plain if word.isascii() and word.islower() else letters).append(k)
        only = lambda places: [words[k] for k in places]
        found = [*self._letters(self.plain, only(plain)), *self._letters(self.library, only(letters)), *self._one_by_one(only(rest))]
        ids, sizes = (np.concatenate([np.asarray(x[k], t) for x in found]) for k, t in ((0, self.kind), (1, np.int64)))
        codes = np.empty(len(words), np.int64)
        codes[[*plain, *letters, *rest]] = np.arange(len(self.sizes), len(self.sizes) + len(words))
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, ids])
        return codes

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a text column's rows, one after the other, and the end of each row among them."""
        words = _Parts(column)
        if len(self.sizes) > REMEMBERED:
            self._forget()
        slot = (words.hashes & np.uint64(SLOTS - 1)).astype(np.int64)
        code = self.slot_code[slot]
        other = np.flatnonzero(self.slot_hash[slot] != words.hashes)
        if len(other):
            _, example, inverse = np.unique(words.hashes[other], return_index=True, return_inverse=True)
            at = other[example]
            body = words.lowered
            learnt = self._learn([body[a:b].tobytes().decode() for a, b in zip(words.starts[at].tolist(), words.ends[at].tolist())])
            code[other] = learnt[inverse]
            self.slot_hash[slot[at]], self.slot_code[slot[at]] = words.hashes[at], learnt
        size = self.sizes[code]
        ids = self.ids[textkit.ragged(self.starts[code], size)]
        return ids, np.concatenate([[0], np.cumsum(size)])[words.first[1:]]


@functools.cache
def encoder_of(path: str) -> WordEncoder:
    """The worker's encoder, kept with its words from task to task."""
    return WordEncoder(path)


def write_token_files(docs: DataFrame, path: str, tokenizer_path: str, end_id: int, text: str = "text", chunk_ids: int = CHUNK_IDS) -> None:
    """Writes the token-id files of a table's whole texts in ascending doc_id order.

    Null text: no ids but the end id. Null doc_ids come first; rows with the same doc_id are ordered by a hash of
    their text and then the text, and each is a document. An empty table gives an empty folder of files. Ranges of
    doc_id are sorted each in one task, from disk where needed.
    A very long text is one document in the files, whole. Other columns are not read, whatever their names.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    ranges = pieces(text_bytes(rows), RANGE_BYTES)
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.col("text").asc_nulls_first()]

    def run(batches):
        encoder = encoder_of(tokenizer_path)
        end = np.array([end_id], encoder.kind)
        part, seq, ids, doc_ids, ends, size = TaskContext.get().partitionId(), 0, [], [], [], 0

        def chunk():
            code = EliasFano.of(ends)
            row = [part, seq, doc_ids, encoder.width, np.concatenate(ids).tobytes(), size, code.low_bits, code.low.tobytes(), code.high.tobytes(), code.marks.tobytes()]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _ARROW)], schema=_ARROW)

        for batch in batches:
            for rows in textkit.slices(batch, "text", textkit.SLICE):
                found, stops = encoder.encode(rows.column("text"))
                for doc, a, b in zip(rows.column("doc_id").to_pylist(), [0, *stops[:-1].tolist()], stops.tolist()):
                    n = b - a + 1
                    if doc_ids and size + n > chunk_ids:
                        yield chunk()
                        seq, ids, doc_ids, ends, size = seq + 1, [], [], [], 0
                    ids += (found[a:b], end)
                    doc_ids.append(doc)
                    size += n
                    ends.append(size)
        if doc_ids:
            yield chunk()

    (
        rows.repartitionByRange(ranges, *order[:2])
        .sortWithinPartitions(*order)
        .mapInArrow(run, CHUNK)
        .write.mode("overwrite")
        .option("compression", "none")
        .parquet(path)
    )


def chunk_starts(chunks: DataFrame) -> DataFrame:
    """part, seq and ``chunk_start``, the ids of all chunks before. Two levels: ranges, then chunks of a range."""
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("_total"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    starts = totals.select("part", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    places = chunks.select("part", "seq", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)).alias("_inside"))
    return places.join(starts, "part").select("part", "seq", (F.col("_start") + F.col("_inside")).alias("chunk_start"))


def _placed(spark: SparkSession, path: str, run, fields: str) -> DataFrame:
    """Rows that ``run`` decodes from chunks, with their start among all ids."""
    chunks = spark.read.schema(CHUNK).parquet(path)
    rows = chunks.mapInArrow(run, f"part long, seq long, doc_id long, start long, {fields}")
    names = rows.columns[4:]
    # Stored, so that its size is known when the join is planned: the ids move only where it is large.
    starts = stored(chunk_starts(chunks), "chunk-starts")
    return rows.join(starts, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("chunk_start")).alias("start"), *names)


def _documents(batch):
    """(part, seq, doc_id, start in the chunk, ids as an array) of each document in a batch of chunks."""
    for row in batch.to_pylist():
        ends = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["marks"]).values()
        ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        start = 0
        for doc, end in zip(row["doc_ids"], ends.tolist()):
            yield row["part"], row["seq"], doc, start, ids[start:end]
            start = end


def _wanted(doc_ids: frozenset, batch):
    """Like ``_documents``, of the wanted documents only: their bounds by ``select``, without decoding the other ends."""
    for row in batch.to_pylist():
        ends = EliasFano(len(row["doc_ids"]), row["low_bits"], row["low"], row["high"], row["marks"])
        ids = np.frombuffer(row["ids"], f"<u{row['width']}")
        for i, doc in enumerate(row["doc_ids"]):
            if doc in doc_ids:
                start = ends.select(i - 1) if i else 0
                yield row["part"], row["seq"], doc, start, ids[start : ends.select(i)]


def _mapped(of_ids, kinds, documents=_documents):
    """Function for mapInArrow: decodes one chunk at a time and describes each document's ids."""

    def run(batches):
        for batch in batches:
            for at in range(batch.num_rows):
                rows = [(*place, *of_ids(ids)) for *place, ids in documents(batch.slice(at, 1))]
                columns = zip(*rows) if rows else [[] for _ in range(4 + len(kinds))]
                names = ["part", "seq", "doc_id", "start", *kinds]
                types = [pa.int64()] * 4 + list(kinds.values())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(columns, types)], names)

    return run


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, ids (array<int>) of each document, from the files alone."""
    run = _mapped(lambda ids: (ids.astype(np.int32),), {"ids": pa.list_(pa.int32())})
    return _placed(spark, path, run, "ids array<int>")


def look_up(spark: SparkSession, path: str, doc_ids) -> DataFrame:
    """doc_id, start, ids of the documents with some doc_ids (None for null ones), each read by its place in its chunk."""
    run = _mapped(lambda ids: (ids.astype(np.int32),), {"ids": pa.list_(pa.int32())}, functools.partial(_wanted, frozenset(doc_ids)))
    return _placed(spark, path, run, "ids array<int>")


def digests(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files alone."""
    run = _mapped(lambda ids: (len(ids), zlib.crc32(ids.astype("<u4").tobytes())), {"n_tokens": pa.int64(), "ids_crc32": pa.int64()})
    return _placed(spark, path, run, "n_tokens long, ids_crc32 long")
