"""Token counts with a whole-token shortcut for a sentencepiece model.

No piece of the model has a space mark after another character (checked when the table is built), so
merges never cross the place before a run of spaces: a text falls apart into pre-tokens, each a run of
spaces and the word after it, whose tokens are counted on their own. Offline, on the driver, every
vocabulary string that is a space mark and a word is encoded alone; those that come back as their own
single token are proven and count 1 without any merging. Only the remaining pre-tokens go
through the library's merges.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Other pre-tokens that a worker remembers before it starts afresh.
REMEMBERED = 300_000
#: Rows turned into Python strings at once.
ROWS = 256


def proven_words(model_path: str) -> frozenset[str]:
    """Words that, after one space, encode as one token; raises if pre-tokens of the model aren't independent."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path)
    texts = [model.id_to_piece(i) for i in range(model.vocab_size())]
    if any(MARK in piece.lstrip(MARK) for piece in texts):
        raise ValueError("a piece has a space mark inside: words of this model aren't independent")
    if model.encode("a", out_type=str)[0][:1] != MARK or model.decode(model.encode("  a ")) != "  a ":
        raise ValueError("the model drops spaces or adds none in front")
    words = [piece[1:] for piece in texts if piece[:1] == MARK and len(piece) > 1 and piece[1] != MARK]
    return frozenset(w for w, ids in zip(words, model.encode(words)) if len(ids) == 1 and model.id_to_piece(ids[0]) == MARK + w)


class _Counts(dict):
    """Tokens of pre-tokens, by their text without the first space; unknown ones are merged by the library."""

    def __init__(self, proven: frozenset[str], model_path: str):
        import sentencepiece

        super().__init__(dict.fromkeys(proven, 1))
        self.proven, self.model = proven, sentencepiece.SentencePieceProcessor(model_file=model_path)

    def __missing__(self, word: str) -> int:
        # The library puts a space in front by itself; a lone space is a token.
        n = self[word] = len(self.model.encode(word)) if word else 1
        return n

    def trim(self) -> None:
        if len(self) > REMEMBERED + len(self.proven):
            self.clear()
            self.update(dict.fromkeys(self.proven, 1))


_RUNS = re.compile(" +[^ ]*")


def count(text: str | None, counts: _Counts) -> int:
    if not text:
        return 0
    if MARK in text:  # the model writes spaces as this mark, so both are the same to it
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return sum(counts[run[1:]] for run in _RUNS.findall(" " + text))
    return sum(map(counts.__getitem__, text.split(" ")))


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for each row, as the library counts the whole text.

    The table of proven words is as large as the vocabulary at most and travels with the task. Null and
    empty texts count 0; repeated rows are counted each; other columns are not read.
    A very long text is counted whole. No ties arise; an empty table gives no rows.
    """
    proven = proven_words(model_path)

    def run(batches):
        counts = _Counts(proven, model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                n = [count(t, counts) for t in part.column("_text").to_pylist()]
                counts.trim()
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("n_bytes"), pa.array(n, pa.int64())], ["doc_id", "n_bytes", "n_tokens"]
                )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("n_bytes"), F.col(text).alias("_text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_bytes long, n_tokens long").withColumn("over_limit", F.col("n_tokens") > limit)
