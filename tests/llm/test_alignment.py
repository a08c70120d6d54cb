"""Cross-tokenizer alignment against a version that encodes whole texts and counts in plain Python."""

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tickloom.llm import alignment
from test_tokens import ODD

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    from tokenizers.decoders import ByteLevel

    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B), ByteLevel()


def letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return dict(zip([chr(b) for b in plain] + [chr(256 + k) for k in range(256 - len(plain))], plain + sorted(set(range(256)) - set(plain))))


def groups_of(text, libraries, table=letters()):
    """Groups of ids by offsets, from the whole text's tokens."""
    if not text:
        return []
    a, b, _ = libraries
    first = a.encode(" " + text, add_special_tokens=False)
    second = b.encode(text)
    a_bytes = [bytes(table[c] for c in token) for token in first.tokens]
    b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in ((i, b.id_to_piece(i)) for i in second)]
    if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
        return []
    a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
    groups, i, j = [], 0, 0
    for end in sorted(set(a_ends.tolist()) & set(b_ends.tolist())):
        p, q = int(np.searchsorted(a_ends, end)) + 1, int(np.searchsorted(b_ends, end)) + 1
        groups.append((first.ids[i:p], second[j:q]))
        i, j = p, q
    return groups


def brute(texts, libraries):
    links = []
    every = [groups_of(t, libraries) for t in texts]
    for groups in every:
        links.append(Counter((x, y) for a, b in groups for x in a for y in b))
    counts = Counter(pair for link in links for pair in link)
    best = Counter()
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    out = []
    for groups, link in zip(every, links):
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out.append((
            sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(link.values()),
            hashlib.sha256(text.encode()).hexdigest() if groups else "",
            sum(n for pair, n in link.items() if counts[pair] == best[pair[0]]), sum(n * counts[pair] for pair, n in link.items()),
        ))
    return out


def rows(frame, **options):
    return sorted(map(tuple, alignment.aligned(frame, A, B, **options).collect()), key=repr)


SPACED = ["a\n b", "a\n  b  ", " ", "  ", "a ", "a  ", " a", "x  y", "x　 y  z", "é à ö", "a\t b\r\n c", "a\x1c b", "᠎ a", "<0x41> <unk>", "a\x00 b", "can't  won't 's"]


@pytest.mark.parametrize("fan, run_bytes", [(64, 4 << 20), (4, 1000)])
def test_against_whole_texts(spark, libraries, fan, run_bytes):
    rng = random.Random(1)
    words = ["the", "The", "token", "izer", "naïve", "中文字", "42", "foo_bar", "...", "🎉", "\n", "", "aaaaaaaaaa", "don't"]
    texts = ODD + SPACED + [rng.choice([" ", "  ", "\n"]).join(rng.choices(words, k=rng.randint(1, 60))) for _ in range(60)]
    texts += texts[-3:]
    docs = [(i if i % 5 else None, t, 1, "x") for i, t in enumerate(texts)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, node int, radix string").repartition(3)
    assert rows(frame, fan=fan, run_bytes=run_bytes) == sorted(((d, *r) for (d, *_), r in zip(docs, brute(texts, libraries))), key=repr)


def test_on_the_given_table(spark, libraries):
    docs = duckdb.sql("SELECT doc_id, text FROM '/root/testdata/sf0.001/documents.parquet'").fetchall()
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    wanted = sorted(((d, *r) for (d, _), r in zip(docs, brute([t for _, t in docs], libraries))), key=repr)
    assert rows(frame, fan=3, run_bytes=1 << 16) == wanted


@pytest.fixture(scope="module")
def aligner():
    return alignment.Aligner(A, B)


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.sampled_from("ab etT'sdré中🎉 \n\t    \x85\x1c0.<|>▁᠎"), min_size=1, max_size=40) | st.text(min_size=1, max_size=30))
def test_pieces_spell_the_whole_text(text, aligner, libraries):
    import pyarrow as pa

    facts, digests, *_ = aligner.run(pa.array([text]))
    groups = groups_of(text, libraries)
    assert facts[0].tolist() == [sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), sum(len(a) * len(b) for a, b in groups)]
    joined = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    assert digests == [hashlib.sha256(joined.encode()).hexdigest() if groups else ""]


def test_long_text_and_empty_table(spark, libraries):
    """Texts longer than a run: words, and one without any space."""
    texts = ["some words again " * 3000, "x" * 3000, "short words"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id int, text string")
    assert rows(frame, run_bytes=1 << 13) == sorted(((i, *r) for i, r in enumerate(brute(texts, libraries))), key=repr)
    assert rows(frame.filter(F.lit(False))) == []


def test_heap_merge_sums_equal_codes():
    rng = np.random.default_rng(2)
    lists = [(np.unique(rng.integers(0, 50, 20)), None) for _ in range(9)]
    lists = [(codes, rng.integers(1, 9, len(codes))) for codes, _ in lists]
    wanted = Counter()
    for codes, counts in lists:
        wanted.update(dict(zip(codes.tolist(), counts.tolist())))
    assert list(alignment.heap_merged(lists)) == sorted(wanted.items())
