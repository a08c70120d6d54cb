"""Registered queries of this subpackage and their DuckDB equivalents."""

from __future__ import annotations

from tickloom.llm import sql
from tickloom.llm.common import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_chat(spark, sf_dir):
    from tickloom.llm import chat

    return chat.chat_documents(table(spark, sf_dir, "conversations"))


def op3_quality_rules(spark, sf_dir):
    from pyspark.sql import functions as F

    from tickloom.llm import rules

    base, chosen = rules.passes("base"), rules.passes("v2")
    book = rules.ledger(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return book.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~base).alias("base_failed"), (base & chosen).alias("kept"), "n_lines", F.col("failure_bits"),
    )


def op7_mix(spark, sf_dir):
    from tickloom.llm import mixing

    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))


def op4_token_files(spark, sf_dir):
    from tickloom.llm import token_files
    from tickloom.sources.storage import new_folder

    path = new_folder(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, vocabulary("word_bpe_49k.json"), end_id=1)
    return token_files.digests(spark, path)


def op9_token_counts(spark, sf_dir):
    from tickloom.llm import token_counts

    return token_counts.token_counts(table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_decontaminate(spark, sf_dir):
    from pyspark.sql import functions as F

    from tickloom.llm import decontaminate

    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s.end - s.start)
    return found.select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op10_suffix_dedup(spark, sf_dir):
    from pyspark.sql import functions as F

    from tickloom.llm import suffixes

    # No doc_id is smaller than a null one, as in the SQL.
    found = suffixes.deduplicated(table(spark, sf_dir, "documents"), nulls_last=False)
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


def op5_near_duplicates(spark, sf_dir):
    from tickloom.llm import near_dup

    return near_dup.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), width=2)


def op2_passages(spark, sf_dir):
    from tickloom.llm import passages

    return passages.repeated_passages(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark, sf_dir):
    from tickloom.llm import lines

    return lines.line_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op11_ranked_search(spark, sf_dir):
    from tickloom.llm import search

    return search.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_license_scan(spark, sf_dir):
    from tickloom.llm import licenses

    return licenses.license_labels(table(spark, sf_dir, "documents"))


def op13_alignment(spark, sf_dir):
    from tickloom.llm import alignment

    return alignment.aligned(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


#: Query and DuckDB SQL; None where SQL can't express it, then tests/llm has a brute-force version.
QUERIES = {
    "op1_chat": (op1_chat, sql.OP1),
    "op2_passages": (op2_passages, None),
    "op3_quality_rules": (op3_quality_rules, sql.OP3),
    "op4_token_files": (op4_token_files, None),
    "op5_near_duplicates": (op5_near_duplicates, sql.OP5),
    "op6_line_dedup": (op6_line_dedup, sql.OP6),
    "op7_mix": (op7_mix, sql.OP7),
    "op8_decontaminate": (op8_decontaminate, sql.OP8),
    "op9_token_counts": (op9_token_counts, None),
    "op10_suffix_dedup": (op10_suffix_dedup, sql.OP10),
    "op11_ranked_search": (op11_ranked_search, sql.OP11),
    "op12_license_scan": (op12_license_scan, sql.OP12),
    "op13_alignment": (op13_alignment, None),
    "pipeline": (pipeline, None),
}


def queries():
    return {name: query for name, (query, _) in QUERIES.items()}


def oracle_sql():
    return {name: text for name, (_, text) in QUERIES.items() if text is not None}
