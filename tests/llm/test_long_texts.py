"""Texts longer than the pieces and slices that tasks cut their work in, against the libraries and brute force."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest

from tickloom.llm import decontaminate, lines, near_dup, passages, rules, suffixes, textkit, token_counts, token_files

PIECES, WORDS = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def texts():
    """Two long near copies, a long text that shares a passage with them across the first piece's end, and short ones."""
    random = np.random.default_rng(3)
    vocabulary = np.array(["".join(chr(97 + c) for c in random.integers(0, 26, n)) for n in random.integers(2, 9, 30_000)])
    first = vocabulary[random.integers(0, len(vocabulary), 230_000)]
    second = first.copy()
    second[random.integers(0, len(second), 2_000)] = "changed"
    other = vocabulary[random.integers(0, len(vocabulary), 230_000)]
    at = int(np.searchsorted(np.cumsum([len(w) + 1 for w in other]), textkit.PIECE)) - 40
    other[at : at + 80] = first[1_000:1_080]
    lined = lambda words: "\n".join(" ".join(words[k : k + 12]) for k in range(0, len(words), 12))
    out = {1: lined(first), 2: lined(second), 3: lined(other), 4: "a short text", 5: "", 6: None}
    assert min(len(out[d]) for d in (1, 2, 3)) > textkit.PIECE * 5 // 4
    return out, first, at


@pytest.fixture(scope="module")
def docs(spark, texts):
    return spark.createDataFrame(list(texts[0].items()), "doc_id long, text string").repartition(2).cache()


def words_of(text):
    return re.findall(r"[^ \t-\r]+", text or "")


def shingles(text):
    words = words_of(text)
    return {tuple(words[k : k + 5]) for k in range(max(0, len(words) - 4))} or ({tuple(words)} if words else set())


def test_near_duplicates_and_rules(docs, texts):
    found = {r["doc_id"]: r for r in near_dup.near_duplicates(docs).collect()}
    sets = {d: shingles(t) for d, t in texts[0].items()}
    assert {d: r["n_shingles"] for d, r in found.items()} == {d: len(s) for d, s in sets.items()}
    assert 100 * len(sets[1] & sets[2]) >= 80 * len(sets[1] | sets[2])
    assert {d: r["component_id"] for d, r in found.items()} == {1: 1, 2: 1, 3: 3, 4: 4, 5: 5, 6: 6}
    counts = {r["doc_id"]: (r["n_words"], r["word_chars"]) for r in rules.measured(docs).select("doc_id", "n_words", "word_chars").collect()}
    assert counts == {d: (len(words_of(t)), sum(map(len, words_of(t)))) for d, t in texts[0].items()}


def test_token_counts_and_files(spark, docs, texts, tmp_path):
    import sentencepiece
    from tokenizers import Tokenizer

    pieces, words = sentencepiece.SentencePieceProcessor(model_file=PIECES), Tokenizer.from_file(WORDS)
    found = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.token_counts(docs, PIECES).collect()}
    assert found == {d: (len((t or "").encode()), len(pieces.encode(t or "", num_threads=1))) for d, t in texts[0].items()}
    token_files.write_token_files(docs, str(tmp_path / "ids"), WORDS, 1)
    files = {r["doc_id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in token_files.digests(spark, str(tmp_path / "ids")).collect()}
    want, start = {}, 0
    for d, t in sorted(texts[0].items()):
        ids = words.encode(t or "", add_special_tokens=False).ids + [1]
        want[d], start = (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), start + len(ids)
    assert files == want


def test_benchmark_items_across_pieces(spark, docs, texts):
    all_texts, first, at = texts
    items = spark.createDataFrame([("early", " ".join(first[1_005:1_050])), ("late", " ".join(first[-30:]))], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontaminate.contamination(docs, items).collect()}
    assert [tuple(s) for s in found[3]["spans"]] == [(at + 5, at + 50)] and found[3]["items"] == ["early"]
    assert found[1]["items"] == ["early", "late"] and found[1]["n_words"] == len(first) and not found[4]["spans"]


def test_bytes_of_earlier_documents(docs, texts):
    found = {r["doc_id"]: r for r in suffixes.deduplicated(docs).select("doc_id", "n_bytes", "n_removed", "kept_sha256").collect()}
    seen: set[int] = set()
    for d, text in sorted(texts[0].items()):
        data = (text or "").encode()
        windows = [hash(data[k : k + 50]) for k in range(len(data) - 49)]
        gone = np.zeros(len(data) + 1, np.int64)
        for k, w in enumerate(windows):
            if w in seen:
                gone[k] += 1
                gone[min(k + 50, len(data))] -= 1
        seen.update(windows)
        removed = np.cumsum(gone)[: len(data)] > 0
        kept = np.frombuffer(data, np.uint8)[~removed].tobytes()
        assert (found[d]["n_bytes"], found[d]["n_removed"], found[d]["kept_sha256"]) == (len(data), int(removed.sum()), hashlib.sha256(kept).hexdigest()), d


def test_lines_and_passages(docs, texts):
    all_texts = texts[0]
    report = {r["doc_id"]: r for r in lines.line_report(docs).collect()}
    earlier = set(all_texts[1].split("\n"))
    assert report[2]["n_equal"] >= sum(line in earlier for line in all_texts[2].split("\n")) and report[2]["n_near"] > 0
    assert report[1]["n_equal"] == report[3]["n_equal"] == 0
    found = passages.repeated_passages(docs).where("doc_id = 3").collect()
    assert sum(r["n_words"] for r in found) >= 80 and {r["ref_doc_id"] for r in found} == {1}
    covered = passages.repeated_passages(docs).where("doc_id = 2").groupBy().sum("n_words").first()[0]
    assert covered > 0.97 * len(texts[1])
