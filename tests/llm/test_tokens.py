"""Token counts and token-id files against the libraries themselves."""

import tracemalloc
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tickloom.llm import token_counts, token_files

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    None, "", " ", "   ", "a", " a  b\n c ", "▁x ▁▁y", "<s> </s><unk>", "it's I'LL don''t", "é é ﬁ Å", "\x00\x1c\x1d a",
    "a<|endoftext|>b <|startoftext|> <|endoftext|", "a b c　d\x85e", "ΑΣ ΣΑΣ İ", "x" * 5000, "日本語 テスト 12345 ..!!", "\t\r\n\x0b\x0c", "🎉🏽 ok",
]


def library_pieces():
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=PIECES)


def library_words():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(WORDS)


@pytest.fixture(scope="module")
def counts():
    return token_counts._Counts(token_counts.proven_words(PIECES), PIECES)


alphabet = st.text(st.sampled_from("ab etThH \n\t▁'s.é́中🎉\x00<|>/1"), max_size=60)


@settings(max_examples=300, deadline=None)
@given(text=alphabet | st.text(max_size=40))
def test_count_is_the_librarys(text, counts):
    assert token_counts.count(text, counts) == len(counts.model.encode(text))


@settings(max_examples=300, deadline=None)
@given(text=alphabet | st.text(max_size=40))
def test_ids_are_the_librarys(text):
    encoder = test_ids_are_the_librarys.__dict__.setdefault("e", token_files.WordEncoder(WORDS))
    found, stops = encoder.encode(pa.array([text, None, text]))
    assert found[: stops[0]].tolist() == found[stops[1] :].tolist() and stops[0] == stops[1]
    assert found[: stops[0]].tolist() == encoder.library.encode(text, add_special_tokens=False).ids


def frame(spark, texts):
    return spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, n_tokens string").repartition(3)


def test_token_counts_of_a_table(spark):
    library = library_pieces()
    rows = {r.doc_id: r for r in token_counts.token_counts(frame(spark, ODD), PIECES, limit=20).collect()}
    for i, text in enumerate(ODD):
        n = len(library.encode(text or ""))
        assert (rows[i].n_bytes, rows[i].n_tokens, rows[i].over_limit) == (len((text or "").encode()), n, n > 20)
    assert token_counts.token_counts(frame(spark, []), PIECES).count() == 0


def test_files_round_trip(spark, tmp_path):
    texts = ODD + ["repeated row"] * 2
    rows = frame(spark, texts).union(spark.createDataFrame([(3, "twin", "x"), (None, "no id", "x")], "doc_id long, text string, n_tokens string"))
    path = str(tmp_path / "ids")
    token_files.write_token_files(rows, path, WORDS, end_id=1, chunk_ids=50)
    back = token_files.read_token_files(spark, path).collect()
    library = library_words()
    given = [(r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids + [1]) for r in rows.collect()]
    assert sorted((str(r.doc_id), list(r.ids)) for r in back) == sorted((str(d), i) for d, i in given)
    place = 0
    ordered = sorted(back, key=lambda r: r.start)
    for r in ordered:
        assert r.start == place
        place += len(r.ids)
    ids = [-1 if r.doc_id is None else r.doc_id for r in ordered]
    assert ids == sorted(ids)
    crc = {(r.doc_id, r.start): (r.n_tokens, r.ids_crc32) for r in token_files.digests(spark, path).collect()}
    for r in back:
        assert crc[r.doc_id, r.start] == (len(r.ids), zlib.crc32(np.array(r.ids, "<u4").tobytes()))


def test_empty_table_makes_empty_files(spark, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(frame(spark, []), path, WORDS, end_id=1)
    assert token_files.digests(spark, path).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5000), max_size=300))
def test_elias_fano(gaps):
    values = np.cumsum(gaps).tolist() if gaps else []
    code = token_files.EliasFano.of(values)
    again = token_files.EliasFano(code.n, code.low_bits, code.low.tobytes(), code.high.tobytes(), code.marks.tobytes())
    assert again.values().tolist() == values
    assert [again.select(i) for i in range(len(values))] == values
    if values:
        bits = 8 * (len(code.low) + len(code.high))
        assert bits <= len(values) * (3 + max(0, (values[-1] // len(values)).bit_length())) + 24


def test_look_up_reads_bounds_by_select(spark, tmp_path, monkeypatch):
    rows = frame(spark, ODD * 30).union(spark.createDataFrame([(3, "twin", "x"), (None, "no id", "x")], "doc_id long, text string, n_tokens string"))
    path = str(tmp_path / "ids")
    token_files.write_token_files(rows, path, WORDS, end_id=1, chunk_ids=1500)
    every = token_files.read_token_files(spark, path).collect()
    for wanted in ({0, 3, 77, 10**9}, {None, 5}, set(), {r.doc_id for r in every}):
        got = token_files.look_up(spark, path, wanted).collect()
        assert sorted(map(str, got)) == sorted(str(r) for r in every if r.doc_id in wanted)
    # No bounds of other documents are decoded.
    monkeypatch.setattr(token_files.EliasFano, "values", None)
    batch = pa.RecordBatch.from_pandas(spark.read.schema(token_files.CHUNK).parquet(path).toPandas())
    assert {doc for _, _, doc, *_ in token_files._wanted(frozenset({3, 77}), batch)} == {3, 77}


def test_remembered_words_take_bounded_memory():
    """A worker keeps arrays of a few numbers a word, and forgets: texts of ever new words don't fill it."""
    encoder = token_files.WordEncoder(WORDS)
    texts = lambda k: pa.array([" ".join(f"w{n}x" for n in range(at, at + 100)) for at in range(10_000 * k, 10_000 * k + 10_000, 100)])
    encoder.encode(texts(0))
    tracemalloc.start()
    for k in range(1, 9):
        encoder.encode(texts(k))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert held < 50 * 80_000


def test_words_that_share_a_place_or_were_forgotten(monkeypatch):
    monkeypatch.setattr(token_files, "SLOTS", 4)
    monkeypatch.setattr(token_files, "REMEMBERED", 30)
    encoder, library = token_files.WordEncoder(WORDS), library_words()
    for k in range(20):
        texts = [f"the cat{k} sat, the cat{n} isn't Ünïque {n}." for n in range(k, k + 5)] + ["", None]
        found, stops = encoder.encode(pa.array(texts))
        wanted = [library.encode(t or "", add_special_tokens=False).ids for t in texts]
        assert found.tolist() == [i for ids in wanted for i in ids]
        assert stops.tolist() == np.cumsum([len(ids) for ids in wanted]).tolist()
        assert len(encoder.sizes) < 30 + 100
