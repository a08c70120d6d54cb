"""Registered queries against DuckDB, and the pipeline against brute force, on the small tables."""

import pathlib
import sys
import zlib

import duckdb
import numpy as np
import pytest

sys.path[:0] = [str(pathlib.Path(__file__).resolve().parents[1]), str(pathlib.Path(__file__).resolve().parent)]

import compare  # noqa: E402
import corpus_pipeline  # noqa: E402
import test_decontaminate  # noqa: E402
import test_near_dup  # noqa: E402
import test_rules_mixing_chat as small  # noqa: E402

from tickloom.llm import mixing, queries, rules  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, name):
    mine = compare.rows_of_spark(queries.queries()[name](spark, SF))
    assert compare.differences(mine, compare.rows_of_duckdb(compare.connect(SF), queries.oracle_sql()[name])) is None


def test_native_queries_run_no_python(spark):
    for name in ("op1_chat", "op3_quality_rules", "op7_mix"):
        plan = queries.queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))


def test_pipeline_is_each_stage_by_hand(spark):
    docs = [dict(zip(["doc_id", "text", "lang", "source", "n_chars"], r)) for r in duckdb.sql(f"SELECT * FROM '{SF}/documents.parquet'").fetchall()]
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    names = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]

    def good(text):
        m = dict(zip(names, small.measured(text)))
        return not (
            m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"] or 10 * m["n_symbols"] > m["n_words"]
            or 10 * m["n_dup_lines"] > 3 * m["n_lines"] or not 2 * m["n_words"] <= m["word_chars"] <= 15 * m["n_words"]
        )

    docs = [d for d in docs if good(d["text"])]
    keep = {r[0] for r in test_near_dup.brute([(d["doc_id"], d["text"]) for d in docs], 5, 80) if r[3]}
    docs = [d for d in docs if d["doc_id"] in keep]
    hits = {int(r[0]): r for r in test_decontaminate.brute([(d["doc_id"], d["text"]) for d in docs], items)}
    docs = [d for d in docs if 2 * hits[d["doc_id"]][2] <= hits[d["doc_id"]][1]]

    stages, rows = dict(corpus_pipeline.STAGES), spark.read.parquet(f"{SF}/documents.parquet")
    for name in ("quality_rules", "near_duplicates", "benchmark_decontamination"):
        rows = stages[name](spark, rows, SF)
    after = {r.doc_id: r.text for r in rows.collect()}
    assert set(after) == {d["doc_id"] for d in docs}
    for d in docs:  # a text without hits stays, the others lose their hit words
        left = len(test_decontaminate.split(after[d["doc_id"]]))
        assert after[d["doc_id"]] == d["text"] if not hits[d["doc_id"]][2] else abs(left - hits[d["doc_id"]][1] + hits[d["doc_id"]][2]) <= 1

    frame = spark.createDataFrame([(d["doc_id"], after[d["doc_id"]], d["source"]) for d in docs], "doc_id long, text string, source string")
    copies = {r.doc_id: -(-r.taken // r.size) for r in mixing.mix(frame).collect() if r.taken}
    from tokenizers import Tokenizer

    library, wanted, start = Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json")), [], 0
    for d in sorted(copies):
        ids = np.array(library.encode(after[d], add_special_tokens=False).ids + [1], "<u4")
        for _ in range(copies[d]):
            wanted.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(wanted)


def test_ledger_reads_the_text_once(spark):
    plan = rules.ledger(spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "Exchange" not in plan
