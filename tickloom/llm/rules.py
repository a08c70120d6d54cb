"""Quality rules as a ledger of failure bits and measurements.

Every rule is evaluated once per document. The ledger keeps the measurements and one long whose bit
``r`` says that rule ``r`` failed. A policy is a named, versioned set of rules, that is a mask: applying
another policy, or finding what each rule alone rejects, is arithmetic on the stored bits and never
reads a text again.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.common import SPACES, let

#: Words per window whose repetition counts.
WINDOW = 3


@dataclass(frozen=True)
class Rule:
    """``failed`` is a condition on measurement columns; ``bit`` never changes once it is in use."""

    bit: int
    name: str
    failed: Callable[[], Column]


RULES = (
    Rule(0, "few_words", lambda: F.col("n_words") < 50),
    Rule(1, "repeated_windows", lambda: 100 * F.col("n_repeat_words") > 50 * F.col("n_words")),
    Rule(2, "many_symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule(3, "repeated_lines", lambda: 10 * F.col("n_dup_lines") > 3 * F.col("n_lines")),
    Rule(4, "short_words", lambda: F.col("word_chars") < 2 * F.col("n_words")),
    Rule(5, "long_words", lambda: F.col("word_chars") > 15 * F.col("n_words")),
)

#: Versioned policies: the rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "many_symbols", "repeated_lines"),
    "v2": tuple(rule.name for rule in RULES),
}


def mask(policy: str, rules=RULES) -> int:
    return sum(1 << rule.bit for rule in rules if rule.name in POLICIES[policy])


def _repeated(grams: Column) -> Column:
    """Words inside windows that occur twice or more, from the hashes of the windows in order."""
    order = F.sort_array(F.transform(grams, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def of_sorted(s: Column) -> Column:
        like_next = F.zip_with(s, F.slice(s, 2, F.size(s)), lambda a, b: F.coalesce(a.h == b.h, F.lit(False)))
        both = let(
            like_next,
            lambda e: F.zip_with(
                e, F.concat(F.array(F.lit(False)), e), lambda x, y: F.coalesce(x, F.lit(False)) | F.coalesce(y, F.lit(False))
            ),
        )
        marked = F.filter(
            F.zip_with(s, both, lambda a, f: F.struct(a.i.alias("i"), f.alias("f"))), lambda z: z.f & z.i.isNotNull()
        )
        starts = F.sort_array(F.transform(marked, lambda z: z.i))
        covered = let(
            starts,
            lambda p: F.zip_with(
                p, F.slice(p, 2, F.size(p)), lambda a, b: F.coalesce(F.least(b - a, F.lit(WINDOW)), F.lit(WINDOW))
            ),
        )
        return F.aggregate(covered, F.lit(0).cast("long"), lambda acc, x: acc + x)

    return let(order, of_sorted)


def _repeat_words(words: Column) -> Column:
    def of_words(w: Column) -> Column:
        grams = F.transform(F.sequence(F.lit(0), F.size(w) - WINDOW), lambda i: F.xxhash64(*[w[i + k] for k in range(WINDOW)]))
        return let(
            grams,
            lambda g: F.when(F.size(F.array_distinct(g)) == F.size(g), F.lit(0).cast("long")).otherwise(_repeated(g)),
        )

    return F.when(F.size(words) <= WINDOW, F.lit(0).cast("long")).otherwise(let(words, of_words))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds the measurements of a text column; columns of the same names are replaced.

    Words are maximal runs without white space. ``n_repeat_words`` counts words inside
    three-word windows that occur twice or more in the text (windows are told apart by 64-bit
    hashes). A null or empty text measures 0 everywhere. Work is linear in a text apart from the sort
    of its windows, done only where some window repeats; nothing is shuffled.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(body, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]"))
    return (
        docs.withColumns({"_words": F.array_remove(F.split(body, SPACES, -1), ""), "_lines": lines})
        .withColumns(
            {
                "n_words": F.size("_words").cast("long"),
                "word_chars": F.length(F.regexp_replace(body, SPACES, "")).cast("long"),
                "n_symbols": F.regexp_count(body, F.lit(r"[#*$%&|<>]")).cast("long"),
                "n_lines": F.size("_lines").cast("long"),
                "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
                "n_repeat_words": _repeat_words(F.col("_words")),
            }
        )
        .drop("_words", "_lines")
    )


def ledger(docs: DataFrame, text: str = "text", rules=RULES) -> DataFrame:
    """``docs`` with the measurements and ``failure_bits`` (long), every rule evaluated once.

    Nulls: a null text measures 0 and so fails the rules that ask for content. Repeated rows each get
    their own row; an empty table gives an empty ledger.
    """
    bits = F.lit(0).cast("long")
    for rule in rules:
        bits = bits.bitwiseOR(F.when(F.coalesce(rule.failed(), F.lit(True)), F.lit(1 << rule.bit).cast("long")).otherwise(0))
    return measured(docs, text).withColumn("failure_bits", bits)


def passes(policy: str, bits: str = "failure_bits") -> Column:
    """Whether a row of the ledger passes a policy."""
    return F.col(bits).bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablation(book: DataFrame, policy: str, rules=RULES, bits: str = "failure_bits") -> DataFrame:
    """Per rule of a policy: documents that fail it, and documents that it alone rejects.

    One aggregation over the distinct values of the bits, at most two to the number of rules.
    Columns: policy, rule, n_failed, n_only (kept if the rule were dropped).
    """
    used = [rule for rule in rules if rule.name in POLICIES[policy]]
    seen = F.col(bits).bitwiseAND(F.lit(mask(policy, rules)).cast("long"))
    counts = book.groupBy(seen.alias("_bits")).agg(F.count("*").alias("_n"))
    per_rule = F.explode(
        F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("one")) for r in used])
    )
    hit = F.col("_bits").bitwiseAND(F.col("r.one")) != 0
    return (
        counts.withColumn("r", per_rule)
        .groupBy(F.lit(policy).alias("policy"), F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(hit, F.col("_n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.col("_bits") == F.col("r.one"), F.col("_n")).otherwise(0)).alias("n_only"),
        )
    )


def rejected_removed(docs: DataFrame, policy: str = "v2") -> DataFrame:
    """The documents that pass a policy, with the columns they came with."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("_row")).withColumn("_text", F.col("_row.text")).transform(
        lambda d: ledger(d, "_text")
    ).filter(passes(policy)).select("_row.*")
