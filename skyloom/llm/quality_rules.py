"""Rule bitmask ledger: every rule is evaluated once, and policies are masks over the stored bits.

``ledger`` adds nothing but measurements and one ``fail_bits`` word per document. A policy names the
rules that reject; applying another policy, or asking what each rule costs, reads the bits alone.

Defined results: a null or empty text has no words and fails FEW_WORDS; repeated rows are measured
row by row; other columns of the input are not looked at, so their names never clash.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyloom.llm.common import (
    byte_words, category_table, code_points, each, fields, kept_rows, query, table,
)

SYMBOLS = "#*$%&|<>"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters", "n_upper",
    "longest_word",
)


def _m(name: str) -> Column:
    return F.col(f"m.{name}")


#: The bit of a rule is its position here; new rules go to the end, so stored ledgers stay readable.
RULE_NAMES = (
    "few_words", "repeated_words", "symbols", "duplicate_lines", "short_words", "long_words", "shouting",
    "few_letters", "giant_word",
)


def rules() -> dict[str, Column]:
    """Condition of failure per rule over the struct column ``m`` of measurements, in whole numbers."""
    n = _m("n_words")
    return {
        "few_words": n < 50,
        "repeated_words": 100 * _m("n_repeat_words") > 50 * n,
        "symbols": 10 * _m("n_symbols") > n,
        "duplicate_lines": 100 * _m("n_dup_lines") > 60 * _m("n_lines"),
        "short_words": _m("word_chars") < 2 * n,
        "long_words": _m("word_chars") > 20 * n,
        "shouting": 100 * _m("n_upper") > 60 * _m("n_letters"),
        "few_letters": 100 * _m("n_letters") < 50 * _m("word_chars"),
        "giant_word": _m("longest_word") > 2000,
    }


#: Versioned policies: the rules that reject a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base-1": ("few_words", "repeated_words"),
    "web-1": ("few_words", "repeated_words", "symbols", "duplicate_lines", "shouting"),
    "web-2": RULE_NAMES,
}
PRODUCTION = "web-2"


def policy_mask(policy: str | tuple[str, ...]) -> int:
    rules = POLICIES[policy] if isinstance(policy, str) else policy
    return sum(1 << RULE_NAMES.index(rule) for rule in rules)


def repeat_words(words: list[bytes]) -> int:
    """Words that lie in a three-word window found at least twice."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    times = Counter(windows)
    hit = np.zeros(len(words), dtype=bool)
    at = np.flatnonzero(np.fromiter((times[w] > 1 for w in windows), dtype=bool, count=len(windows)))
    for shift in range(3):
        hit[at + shift] = True
    return int(hit.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """All measurements of one text, in the order of MEASURES."""
    words = byte_words(text)
    if not words:
        n_symbols = sum(map(text.count, SYMBOLS)) if text else 0
        return (0, 0, n_symbols) + (0,) * (len(MEASURES) - 3)
    lines = [line for line in text.split("\n") if line.encode().split()]
    points = code_points(text)
    blank = (points == 32) | ((points >= 9) & (points <= 13))
    blanks = int(blank.sum())
    longest = int(np.diff(np.flatnonzero(np.concatenate(([True], blank, [True])))).max()) - 1
    return (
        len(words), len(points) - blanks, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)),
        repeat_words(words), len(lines), int(category_table("L")[points].sum()),
        int(category_table("Lu")[points].sum()), longest,
    )


def measures(text: Column) -> Column:
    """Struct of all measurements of a text column."""
    return each(measure, fields(**{name: T.LongType() for name in MEASURES}))(text)


def fail_bits() -> Column:
    """One long with a bit per failed rule over the struct column ``m`` of measurements."""
    failed = rules()
    return sum((F.when(failed[r], F.lit(1 << k)).otherwise(F.lit(0)) for k, r in enumerate(RULE_NAMES)), F.lit(0)).cast(
        "long"
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, every measurement and ``fail_bits`` per row; one pass, no shuffle."""
    measured = docs.select(F.col(id_col), measures(F.col(text_col)).alias("m"))
    return measured.select(id_col, "m.*", fail_bits().alias("fail_bits"))


def passes(bits: Column, policy: str | tuple[str, ...] = PRODUCTION) -> Column:
    return bits.bitwiseAND(F.lit(policy_mask(policy)).cast("long")) == 0


def ablations(ledger_df: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """Per rule of a policy: documents that fail it, that fail it alone, and that the rest still keeps.

    The ledger collapses to one row per distinct word of bits before anything else looks at it.
    """
    mask = policy_mask(policy)
    seen = (
        ledger_df.select(F.col("fail_bits").bitwiseAND(F.lit(mask).cast("long")).alias("bits"))
        .groupBy("bits").agg(F.count(F.lit(1)).alias("n"))
    )
    bits = [
        F.struct(F.lit(r).alias("rule"), F.lit(1 << RULE_NAMES.index(r)).cast("long").alias("bit"))
        for r in POLICIES[policy]
    ]
    each = seen.select("bits", "n", F.inline(F.array(*bits)))
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("bits").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("failed"),
        F.sum(F.when(F.col("bits") == F.col("bit"), F.col("n")).otherwise(0)).alias("failed_alone"),
        F.sum(F.when(F.col("bits").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0, F.col("n")).otherwise(0))
        .alias("kept_without"),
    )


def keep_documents(docs: DataFrame, policy: str = PRODUCTION, text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that a policy keeps, with their columns unchanged."""
    return kept_rows(docs, text_col, measures, passes(fail_bits(), policy))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text FROM documents),
w AS (
  SELECT r, doc_id, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d),
u AS (SELECT r, unnest(generate_series(1, len(words) - 2)) AS i, words FROM w WHERE len(words) >= 3),
t AS (SELECT r, i, [words[i], words[i + 1], words[i + 2]] AS gram FROM u),
g AS (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS times FROM t),
h AS (SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM g WHERE times > 1) GROUP BY r),
m AS (
  SELECT doc_id, len(words) AS n_words,
    CAST(coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines,
    coalesce(n_repeat_words, 0) AS n_repeat_words,
    CASE WHEN len(words) = 0 THEN 0 ELSE len(lines) END AS n_lines,
    length(text) - length(regexp_replace(text, '\p{L}', '', 'g')) AS n_letters,
    length(text) - length(regexp_replace(text, '\p{Lu}', '', 'g')) AS n_upper,
    CAST(coalesce(list_max(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS longest_word
  FROM w LEFT JOIN h USING (r)),
b AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
    CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT + 4 * (10 * n_symbols > n_words)::INT
      + 8 * (100 * n_dup_lines > 60 * n_lines)::INT + 16 * (word_chars < 2 * n_words)::INT
      + 32 * (word_chars > 20 * n_words)::INT + 64 * (100 * n_upper > 60 * n_letters)::INT
      + 128 * (100 * n_letters < 50 * word_chars)::INT + 256 * (longest_word > 2000)::INT AS BIGINT) AS fail_bits
  FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, fail_bits = 0 AS kept,
  fail_bits FROM b
"""


@query("op4_quality_rules", ORACLE)
def op4_quality_rules(spark, sf_dir):
    found = ledger(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~passes(F.col("fail_bits"), "base-1")).alias("base_failed"),
        passes(F.col("fail_bits")).alias("kept"), "fail_bits",
    )
