"""Fuzzy repeated passages: shared seeds, collinear chains, alignment.

Seeds are minimisers of five-word shingles. Seeds that no second document holds are left out by packed keys
(blocks.py); the others are matched to the seed's first document, the one with the smallest doc_id,
so a seed of many documents gives one match each and not one for each pair. A block names its distinct seeds to buckets of the
hash space, packed and once each, and is answered where an earlier document holds them. So are runs of seeds, two in a row and as many as span
a piece, since the first documents of the single seeds may all differ. Per document and earlier document the
matches are chained in order of both, each step paying for the words it jumps, through a Fenwick tree of best
chains by place in the earlier document. The words around a chain are then aligned: matches outwards from the chain's
ends, and the gaps inside by edit distance. The earlier document's words travel in tiles, each once to every block with
chains that need it.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickloom.llm import blocks as B
from tickloom.llm import textkit
from tickloom.llm.common import pieces, stored, text_bytes

#: Words of a seed, and neighbouring seeds of which the least is taken: ten equal words always share one.
SEED, NEIGHBOURS = 5, 6
#: Words that a document must repeat in one stretch, words of one aligned piece of it, and their equal share.
LENGTH, PIECE, IDENTITY = 50, 20, 0.8
#: Cost of a jumped word on either side, as a share of a seed; a longer gap ends a chain.
JUMP, GAP = 0.01, 64
#: Words looked at beyond the ends of a chain, and words in a tile.
BEYOND, TILE = 48, 64
#: Occurrences of a seed above which packed keys call it common; it is worked on like the others.
COMMON = 4096
#: Extension: a differing word's cost in equal words, and the loss at which it stops.
WRONG, DROP = 2, 6


class Seeds:
    """Seeds of a block: hash, row and first word, in order of rows."""

    def __init__(self, table: pa.Table):
        self.words = w = textkit.Words(table.column("text"))
        self.ids = B.first_of(table.column("doc_id").combine_chunks())
        rows, n = w.rows(), len(w) - SEED + 1
        if n < NEIGHBOURS:
            self.hash, self.row, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
            return
        grams = w.hashes[:n]
        for k in range(1, SEED):
            grams = textkit.mix(grams) + w.hashes[k : k + n]
        places = textkit.minimizers(grams, NEIGHBOURS, rows[: len(w) - SEED - NEIGHBOURS + 2] == rows[SEED + NEIGHBOURS - 2 :])
        self.hash, self.row = textkit.mix(grams[places]), rows[places]
        self.at = places - w.first[self.row]

    @cached_property
    def keys(self) -> B.Keys:
        return B.Keys(self.hash, self.ids[self.row])

    def runs(self, keep: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """Runs of kept seeds, two in a row and as many as span PIECE words: hash with the places in the run, first seed,
        words to the last one."""
        places = self.at + self.words.first[self.row]
        up, down = textkit.powers(len(self.words) + 1)
        total = lambda x: np.concatenate([np.zeros(1, x.dtype), np.cumsum(x)])
        sums, kept = total(self.hash * up[places]), total(keep.astype(np.int64))
        begin, out = np.arange(len(places)), []
        for last in (begin + 1, np.searchsorted(places, places + PIECE - SEED)):
            a = begin[last < len(places)]
            b = last[a]
            whole = (self.row[a] == self.row[b]) & (kept[b + 1] - kept[a] == b + 1 - a)
            a, b = a[whole], b[whole]
            value = (sums[b + 1] - sums[a]) * down[places[a]] + (b - a).astype(np.uint64)
            out.append((textkit.mix(value), a, places[b] - places[a]))
        return out

    def places(self, bits: int, replies: dict[int, bytes]) -> tuple[np.ndarray, ...]:
        """Seeds that a second document holds and their runs: hash, index of the first seed, words to the last one."""
        keep = self.keys.codes(bits, replies)[self.keys.inverse] > 0
        one = np.flatnonzero(keep)
        kinds = [(self.hash[one], one, np.zeros(len(one), np.int64)), *self.runs(keep)]
        return tuple(np.concatenate(x) for x in zip(*kinds))


class Firsts:
    """Distinct hashes of a block's seeds and runs, in order, each with its first document and the first place in it."""

    def __init__(self, seeds: Seeds, hashes: np.ndarray, at: np.ndarray):
        docs, places = seeds.ids[seeds.row[at]], seeds.at[at]
        order = np.lexsort((places, docs, hashes))
        ranked = hashes[order]
        new = np.flatnonzero(np.concatenate([np.ones(min(1, len(ranked)), bool), ranked[1:] != ranked[:-1]]))
        self.hash, self.doc, self.at = ranked[new], docs[order][new], places[order][new]
        self.last = np.maximum.reduceat(docs[order], new) if len(new) else docs
        self.of = np.empty(len(order), np.int64)
        self.of[order] = np.repeat(np.arange(len(new)), np.diff(np.append(new, len(order))))

    def buckets(self, bits: int):
        cuts = np.flatnonzero(np.diff((self.hash >> np.uint64(64 - bits)).astype(np.int64))) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(self.hash)]):
            if b > a:
                yield int(self.hash[a] >> np.uint64(64 - bits)), a, b


def _squeezed(*columns: np.ndarray) -> bytes:
    """Columns of integers as one compressed body, equal bytes of a column side by side."""
    planes = [np.ascontiguousarray(c.astype("<i8").view(np.uint8).reshape(-1, 8).T).ravel() for c in columns]
    return pa.compress(np.concatenate(planes).tobytes(), codec="zstd", asbytes=True)


def _columns(body: bytes, count: int, rows: int) -> list[np.ndarray]:
    flat = np.frombuffer(pa.decompress(body, 8 * count * rows, codec="zstd", asbytes=True) if rows else b"", np.uint8)
    return [np.ascontiguousarray(p.reshape(8, rows).T).view("<i8").ravel() for p in np.split(flat, count)]


_NAMED = "bucket long, block long, n long, body binary"


def _named(bits: int, key_bits: int):
    """Names a block's distinct seeds and runs to the buckets of their hashes."""

    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        docs, rows = B.unpacked(packed), []
        if docs.num_rows:
            seeds = Seeds(docs)
            hashes, at, _ = seeds.places(key_bits, B.by_bucket(replies, 1))
            firsts = Firsts(seeds, hashes, at)
            block = docs.column("block")[0].as_py()
            for bucket, a, b in firsts.buckets(bits):
                part = firsts.hash[a:b].view(np.int64), firsts.doc[a:b], firsts.at[a:b], firsts.last[a:b]
                rows.append((bucket, block, b - a, _squeezed(*part)))
        columns = zip(*rows) if rows else [[]] * 4
        return pa.table([pa.array(c, t) for c, t in zip(columns, [pa.int64()] * 3 + [pa.binary()])], ["bucket", "block", "n", "body"])

    return run


def _answered(table: pa.Table) -> pa.Table:
    """Answers of a bucket: to each block the first document of its hashes, where one of its documents comes after that.

    A bit for each hash, whether it is answered; then the answers: document, its block, place.
    """
    blocks, buckets, sizes, bodies = (table.column(c).to_pylist() for c in ("block", "bucket", "n", "body"))
    named = [_columns(body, 4, n) for body, n in zip(bodies, sizes)]
    hashes, doc, at, last = (np.concatenate(x) for x in zip(*named))
    block = np.repeat(np.array(blocks, np.int64), sizes)
    order = np.lexsort((block, doc, hashes))
    new = np.flatnonzero(np.concatenate([[True], hashes[order][1:] != hashes[order][:-1]]))
    first = np.empty(len(order), np.int64)
    first[order] = np.repeat(order[new], np.diff(np.append(new, len(order))))
    out, begin = [], 0
    for n in sizes:
        mine = first[begin : begin + n]
        hit = last[begin : begin + n] > doc[mine]
        found = mine[hit]
        bits = np.packbits(hit, bitorder="little").tobytes()
        out.append(bits + (_squeezed(doc[found], block[found], at[found]) if len(found) else b""))
        begin += n
    return B.replies(blocks, 2, buckets, out)


def _matched(bits: int, key_bits: int):
    """Chains of a block's documents, from the first documents of their seeds and runs."""

    def run(packed: pa.Table, replies: pa.Table) -> pa.Table:
        docs = B.unpacked(packed)
        none = np.zeros(0, np.int64)
        names = ["block", "doc", "at", "more", "ref", "ref_block", "ref_at"]
        columns = [none] * 7
        if docs.num_rows:
            seeds = Seeds(docs)
            hashes, place, more = seeds.places(key_bits, B.by_bucket(replies, 1))
            firsts, answers = Firsts(seeds, hashes, place), B.by_bucket(replies, 2)
            n = len(firsts.hash)
            hit, found = np.zeros(n, bool), [[none] * 3]
            for bucket, a, b in firsts.buckets(bits):
                body, size = answers[bucket], -(-(b - a) // 8)
                hit[a:b] = np.unpackbits(np.frombuffer(body[:size], np.uint8), count=b - a, bitorder="little")
                found.append(_columns(body[size:], 3, int(hit[a:b].sum())))
            of = np.cumsum(hit) - 1
            doc, ref_block, ref_at = (np.concatenate(x) for x in zip(*found))
            mine = np.flatnonzero(hit[firsts.of])
            to, ids = of[firsts.of[mine]], seeds.ids[seeds.row[place[mine]]]
            later = ids > doc[to]
            mine, to, ids = mine[later], to[later], ids[later]
            block = np.full(len(mine), docs.column("block")[0].as_py())
            columns = [block, ids, seeds.at[place[mine]], more[mine], doc[to], ref_block[to], ref_at[to]]
        return _chained(pa.table([pa.array(c, pa.int64()) for c in columns], names))

    return run


def best_chains(at: list[int], ref: list[int]) -> list[list[int]]:
    """Chains of matches (places in two documents, ordered by the first, then the second), best ones first.

    A chain's score is its matches less JUMP for each word jumped on either side; each match takes the
    best chain that ends before it on both sides and within GAP, from a Fenwick tree of prefix maxima by place in the
    second document; where the best of all ends further off, the matches of the last GAP words are looked through. Every match belongs to one chain at most; chains of one match are left out.
    """
    places = {r: k + 1 for k, r in enumerate(sorted(set(ref)))}
    size = len(places)
    best, which = [0.0] * (size + 1), [-1] * (size + 1)
    score, before = [1.0] * len(at), [-1] * len(at)
    waiting = 0
    for j in range(len(at)):
        if at[j] != at[waiting]:
            for i in range(waiting, j):
                _put(best, which, places[ref[i]], score[i] + JUMP * (at[i] + ref[i]), i)
            waiting = j
        k, most, who = places[ref[j]] - 1, 0.0, -1
        while k:
            if which[k] >= 0 and (who < 0 or best[k] > most):
                most, who = best[k], which[k]
            k &= k - 1
        gain = most - JUMP * (at[j] + ref[j])
        if who >= 0 and gain > 0 and (at[j] - at[who] > GAP or ref[j] - ref[who] > GAP):
            most, who = _near(at, ref, score, waiting, j)
            gain = most - JUMP * (at[j] + ref[j])
        if who >= 0 and gain > 0:
            score[j], before[j] = 1.0 + gain, who
    used, out = [False] * len(at), []
    for j in sorted(range(len(at)), key=lambda k: (-score[k], k)):
        chain = []
        while j >= 0 and not used[j]:
            used[j] = True
            chain.append(j)
            j = before[j]
        if len(chain) > 1:
            out.append(chain[::-1])
    return out


def _near(at: list[int], ref: list[int], score: list[float], end: int, j: int) -> tuple[float, int]:
    """The best chain that ends before match j within GAP on both sides, of the matches before ``end``."""
    most, who, i = 0.0, -1, end - 1
    while i >= 0 and at[j] - at[i] <= GAP:
        if 0 < ref[j] - ref[i] <= GAP and (value := score[i] + JUMP * (at[i] + ref[i])) > most:
            most, who = value, i
        i -= 1
    return most, who


def _put(best: list[float], which: list[int], k: int, value: float, who: int) -> None:
    while k < len(best):
        if which[k] < 0 or value > best[k]:
            best[k], which[k] = value, who
        k += k & -k


_CHAIN = "chain long, block long, doc long, ref_block long, ref long, at array<long>, ref_at array<long>"
_CHAIN_TYPES = pa.schema([(part.split()[0], pa.int64() if part.endswith(" long") else pa.list_(pa.int64())) for part in _CHAIN.split(", ")])


def _chained(table: pa.Table) -> pa.Table:
    """Chains of the matches of a block's documents."""
    column = lambda name: table.column(name).to_numpy()
    doc, ref, ref_block, at, ref_at, more = (column(n) for n in ("doc", "ref", "ref_block", "at", "ref_at", "more"))
    # A run gives its first and its last seed; runs and single seeds may give the same match.
    run = more > 0
    doc, ref, ref_block = (np.concatenate([x, x[run]]) for x in (doc, ref, ref_block))
    at, ref_at = (np.concatenate([x, x[run] + more[run]]) for x in (at, ref_at))
    order = np.lexsort((ref_at, at, ref_block, ref, doc))
    doc, ref, at, ref_at, ref_block = both = [x[order] for x in (doc, ref, at, ref_at, ref_block)]
    if not len(doc):
        return pa.table([pa.array([], f.type) for f in _CHAIN_TYPES], names=_CHAIN_TYPES.names)
    new = np.concatenate([[True], np.logical_or.reduce([x[1:] != x[:-1] for x in both])])
    doc, ref, at, ref_at, ref_block = (x[new] for x in both)
    new = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (ref[1:] != ref[:-1]) | (ref_block[1:] != ref_block[:-1])]))
    rows = []
    for a, b in zip(new.tolist(), np.append(new[1:], len(doc)).tolist()):
        if b - a > 1:
            x, y = at[a:b].tolist(), ref_at[a:b].tolist()
            for chain in best_chains(x, y):
                rows.append((int(doc[a]), int(ref_block[a]), int(ref[a]), [x[k] for k in chain], [y[k] for k in chain]))
    block = table.column("block")[0].as_py()
    docs, blocks, refs, ats, ref_ats = zip(*rows) if rows else [[]] * 5
    longs = pa.list_(pa.int64())
    return pa.table({
        "chain": pa.array(range(len(rows)), pa.int64()), "block": pa.array([block] * len(rows), pa.int64()), "doc": pa.array(docs, pa.int64()),
        "ref_block": pa.array(blocks, pa.int64()), "ref": pa.array(refs, pa.int64()), "at": pa.array(ats, longs), "ref_at": pa.array(ref_ats, longs),
    })


def _lists(column: pa.ChunkedArray) -> list[list[int]]:
    """The lists of a column without nulls."""
    values, out = column.combine_chunks(), []
    cuts, flat = values.offsets.to_numpy().tolist(), values.values.to_numpy().tolist()
    for a, b in zip(cuts, cuts[1:]):
        out.append(flat[a:b])
    return out


def _row_of(ids: np.ndarray) -> dict[int, int]:
    return {int(d): k for k, d in reversed(list(enumerate(ids.tolist())))}


def _tiles(packed: pa.Table, wanted: pa.Table) -> pa.Table:
    """Word hashes of the wanted tiles of a block's documents, four bytes each."""
    out = []
    docs = B.unpacked(packed)
    if docs.num_rows and wanted.num_rows:
        words = textkit.Words(docs.column("text"))
        rows = _row_of(B.first_of(docs.column("doc_id").combine_chunks()))
        small = words.hashes.astype("<u4")
        for ref, tile in zip(wanted.column("ref").to_pylist(), wanted.column("tile").to_pylist()):
            row = rows.get(ref)
            if row is not None:
                a = words.first[row] + tile * TILE
                out.append((ref, tile, small[a : min(a + TILE, words.first[row + 1])].tobytes()))
    block = wanted.column("ref_block")[0].as_py() if wanted.num_rows else 0
    refs, tiles, bodies = zip(*out) if out else [[]] * 3
    return pa.table({"ref_block": pa.array([block] * len(out), pa.int64()), "ref": pa.array(refs, pa.int64()),
                     "tile": pa.array(tiles, pa.int64()), "words": pa.array(bodies, pa.binary())})


def equal_words(x: list[int], y: list[int]) -> int:
    """Words of two short sequences that an alignment of least edit distance keeps, counted along it."""
    if x == y:
        return len(x)
    if len(x) == len(y) and (same := sum(a == b for a, b in zip(x, y))) >= len(x) - 1:
        return same
    # Some best alignment keeps the equal words that both begin and both end with.
    n = min(len(x), len(y))
    begin = next((k for k in range(n) if x[k] != y[k]), n)
    end = next((k for k in range(n - begin) if x[-1 - k] != y[-1 - k]), n - begin)
    x, y = x[begin : len(x) - end], y[begin : len(y) - end]
    # (edits, -kept) of the best alignment of prefixes.
    line = [(j, 0) for j in range(len(y) + 1)]
    for i, a in enumerate(x, 1):
        corner, line[0] = line[0], (i, 0)
        for j, b in enumerate(y, 1):
            match = (corner[0], corner[1] - 1) if a == b else (corner[0] + 1, corner[1])
            corner = line[j]
            line[j] = min(match, (line[j][0] + 1, line[j][1]), (line[j - 1][0] + 1, line[j - 1][1]))
    return begin + end - line[-1][1]


def extension(x: np.ndarray, y: np.ndarray) -> tuple[int, int]:
    """(words, equal words) to go on from the start of two sequences, until differing words cost too much."""
    n = min(len(x), len(y))
    gain = most = kept = end = equal = 0
    for k, (a, b) in enumerate(zip(x[:n].tolist(), y[:n].tolist()), 1):
        if a == b:
            gain, kept = gain + 1, kept + 1
            if gain > most:
                most, end, equal = gain, k, kept
        else:
            gain -= WRONG
            if most - gain > DROP:  # mostly a few words behind a chain's end, so words are looked at one by one
                break
    return end, equal


def align(own: np.ndarray, other: np.ndarray, at: list[int], ref_at: list[int]) -> tuple[int, int, int, int, int]:
    """Aligned piece around a chain: start and end in both sequences, and the equal words in it."""
    left, equal = extension(own[: at[0]][::-1], other[: ref_at[0]][::-1])
    end, ref_end, last = at[0], ref_at[0], 0
    # The words between the first and the last seed as lists, for the gaps.
    begin, ref_begin = end, ref_end
    x, y = own[begin : at[-1]].tolist(), other[ref_begin : ref_at[-1]].tolist()
    for a, r in zip(at, ref_at):
        if a < end or r < ref_end:  # overlaps the seed before: on its diagonal nothing is between, else skip it
            if a - r == last and a + SEED > end:
                equal += a + SEED - end
                end, ref_end = a + SEED, r + SEED
            continue
        equal += equal_words(x[end - begin : a - begin], y[ref_end - ref_begin : r - ref_begin]) + SEED
        end, ref_end, last = a + SEED, r + SEED, a - r
    right, more = extension(own[end:], other[ref_end:])
    return at[0] - left, end + right, ref_at[0] - left, ref_end + right, equal + more


_PASSAGE = "doc_id long, start_word long, n_words long, ref_doc_id long, ref_start_word long, ref_n_words long, n_equal long"
_NAMES = [part.split()[0] for part in _PASSAGE.split(", ")]


def _passages(packed: pa.Table, parts: pa.Table) -> pa.Table:
    """Aligned passages of a block's documents, from their chains and the tiles of the earlier documents."""
    found = []
    docs = B.unpacked(packed)
    if docs.num_rows and parts.num_rows:
        words = textkit.Words(docs.column("text"))
        small = words.hashes.astype("<u4")
        rows = _row_of(B.first_of(docs.column("doc_id").combine_chunks()))
        head = parts.column("words").is_null()
        heads, rest = parts.filter(head), parts.filter(pc.invert(head))
        keys = zip(*(rest.column(c).to_numpy().tolist() for c in ("ref_block", "ref", "tile")))
        tiles = dict(zip(keys, rest.column("words").to_pylist()))
        longs = (heads.column(c).to_numpy().tolist() for c in ("doc", "ref_block", "ref"))
        for doc, ref_block, ref, at, to in zip(*longs, _lists(heads.column("at")), _lists(heads.column("ref_at"))):
            row = rows.get(doc)
            span = range(max(to[0] - BEYOND, 0) // TILE, (to[-1] + SEED + BEYOND) // TILE + 1)
            chain = [(t, body) for t in span if (body := tiles.get((ref_block, ref, t))) is not None]
            if not chain or row is None:
                continue
            offset = chain[0][0] * TILE
            other = np.frombuffer(b"".join(body for _, body in chain), "<u4")
            begin, end = words.first[row], words.first[row + 1]
            ref_at = [r - offset for r in to]
            if ref_at[0] < 0 or len(other) < ref_at[-1] + SEED or at[-1] + SEED > end - begin:
                continue
            a, b, c, d, equal = align(small[begin:end], other, at, ref_at)
            if b - a >= PIECE and equal >= IDENTITY * max(b - a, d - c):
                found.append((doc, a, b - a, ref, c + offset, d - c, equal))
    # Pieces of one stretch: a document's stretch may repeat several others in turn.
    found.sort()
    keep, stretch, end, doc = [], [], -1, None
    for piece in [*found, (None, 0, 0)]:
        if piece[0] != doc or piece[1] > end:
            if stretch and end - stretch[0][1] >= LENGTH:
                keep += stretch
            stretch, end, doc = [], -1, piece[0]
        stretch.append(piece)
        end = max(end, piece[1] + piece[2])
    columns = zip(*keep) if keep else [[]] * len(_NAMES)
    return pa.table([pa.array(c, pa.int64()) for c in columns], _NAMES)


def repeated_passages(docs: DataFrame, text: str = "text", block_bytes: int = B.BLOCK_BYTES, common: int = COMMON) -> DataFrame:
    """Passages of documents that earlier ones hold nearly alike, a row per piece.

    doc_id, start_word, n_words; ref_doc_id, ref_start_word, ref_n_words of a document with a smaller doc_id;
    n_equal. A piece has 20 words or more, of which 4 in 5 are equal in order; pieces that together cover a stretch of 50
    words of a document or more are given. Words are runs without white space, A-Z folded. Null and empty texts
    and those of fewer than ten words have no passages. Rows with one doc_id don't repeat each other; a null doc_id counts as larger than all
    others and stays null. Equal seeds are told by 64 bits, equal words in an alignment by 32. Empty input, empty result.
    A very long text stays whole in one block.. Other columns are not read, whatever their names.
    """
    total = text_bytes(docs, text)
    blocks = B.blocked(docs, total, text, block_bytes)
    bits = B.key_bits(total, 24)
    shared = B.shared_keys(blocks, lambda table: Seeds(B.unpacked(table)).keys, bits, common)
    parts = B.key_bits(total, 12)
    named = blocks.groupBy("block").cogroup(shared.groupBy("block")).applyInArrow(_named(parts, bits), _NAMED)
    answers = shared.unionByName(named.groupBy("bucket").applyInArrow(_answered, B.REPLY))
    chains = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_matched(parts, bits), _CHAIN)
    return _aligned(blocks, stored(chains, "chains"))


def _aligned(blocks: DataFrame, chains: DataFrame) -> DataFrame:
    low = F.greatest(F.element_at("ref_at", 1) - BEYOND, F.lit(0))
    high = F.element_at("ref_at", -1) + SEED + BEYOND
    tile = F.explode(F.sequence(F.floor(low / TILE), F.floor(high / TILE))).alias("tile")
    # A tile goes once to each block, however many of its chains need it.
    spread = chains.select("block", "ref_block", "ref", tile).distinct()
    wanted = spread.select("ref_block", "ref", "tile").distinct()
    tiles = blocks.groupBy("block").cogroup(wanted.groupBy("ref_block")).applyInArrow(_tiles, "ref_block long, ref long, tile long, words binary")
    parts = spread.join(tiles, ["ref_block", "ref", "tile"]).select("block", "ref_block", "ref", "tile", "words")
    heads = chains.select("block", "doc", "ref_block", "ref", "at", "ref_at")
    both = parts.unionByName(heads, allowMissingColumns=True)
    found = blocks.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(_passages, _PASSAGE)
    none = F.lit(np.iinfo(np.int64).max)
    return found.withColumn("doc_id", F.when(F.col("doc_id") != none, F.col("doc_id")))
