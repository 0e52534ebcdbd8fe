"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document.  The ledger keeps its failure bit
(``failed``, bit ``i`` for rule ``i``) and the measurements behind it; a policy is
a versioned mask over those bits, so verdicts, policy changes and ablations are
bitwise work on the ledger and never read a text again.

Defined cases: a null or empty text measures zero everywhere and fails
``few_words``; a very long text is measured whole; repeated rows repeat their result, and
rows do not depend on each other, so there are no ties; ids may be null; an empty table
gives an empty ledger; further columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import shared

#: Characters that count as symbols.
SYMBOLS = "#*$%&|<>"
_WHITE = " \t\n\x0b\x0c\r"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper_words", "n_bangs")

#: Rules in the order of their bits, as conditions on the measurements that a failing document meets.
RULES = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > n_words",
    "repeated_lines": "2 * n_dup_lines > n_lines",
    "word_length": "n_words > 0 and (word_chars < 3 * n_words or word_chars > 14 * n_words)",
    "shouting": "10 * n_upper_words > 3 * n_words",
    "marks": "5 * n_bangs > n_words",
}
BASE = ("few_words", "repeated_words")
#: Policies by version: the rules whose failure drops a document.
POLICIES = {"v1": BASE, "v2": tuple(RULES)}


def mask(rules) -> int:
    names = list(RULES)
    return sum(1 << names.index(r) for r in rules)


def measure(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    words = text.encode().split()  # splits at exactly \\x20 and \\x09-\\x0D
    n = len(words)
    word_chars = len(text) - sum(map(text.count, _WHITE))
    lines = [line for line in text.split("\n") if line.strip(_WHITE)]
    repeat = 0
    grams = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(grams)) < len(grams):
        first: dict = {}
        inside = bytearray(n)
        for i, g in enumerate(grams):
            k = first.setdefault(g, i)
            if k != i:
                inside[k:k + 3] = b"\x01\x01\x01"
                inside[i:i + 3] = b"\x01\x01\x01"
        repeat = sum(inside)
    return (n, word_chars, sum(map(text.count, SYMBOLS)), len(lines), len(lines) - len(set(lines)), repeat,
            sum([w.isupper() for w in words]), text.count("!"))


def ledger(docs: DataFrame) -> DataFrame:
    """``doc_id``, the measurements and ``failed`` (bigint): bit ``i`` is set where rule ``i`` fails."""
    def rows(batches):
        for ids, texts in batches:
            columns = list(zip(*map(measure, texts), strict=True)) or [[] for _ in MEASURES]
            yield {"doc_id": ids, **dict(zip(MEASURES, columns, strict=True))}

    measured = shared.text_map(docs, rows, "doc_id bigint, " + ", ".join(f"{m} bigint" for m in MEASURES))
    bits = sum((F.expr(rule).cast("bigint") * (1 << i) for i, rule in enumerate(RULES.values())), F.lit(0).cast("bigint"))
    return measured.withColumn("failed", bits)


def passes(policy: str, failed: str = "failed") -> Column:
    """True where no rule of the policy failed."""
    return F.col(failed).bitwiseAND(F.lit(mask(POLICIES[policy])).cast("bigint")) == 0


def ablation(book: DataFrame, policy: str) -> DataFrame:
    """Per rule of the policy: documents that fail it, and documents that only it drops.

    One pass over the ledger: rows are first summed by bit pattern (at most
    ``2 ** rules`` groups), and the patterns are compared with each rule's bit.
    """
    names, full = list(RULES), mask(POLICIES[policy])
    patterns = book.groupBy(F.col("failed").bitwiseAND(F.lit(full).cast("bigint")).alias("p")).agg(F.count("*").alias("n"))
    rules = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(1 << names.index(r)).cast("bigint").alias("bit"))
                      for r in POLICIES[policy]])
    each = patterns.select("p", "n", F.explode(rules).alias("r"))
    hit = F.col("p").bitwiseAND(F.col("r.bit")) != 0
    return each.groupBy(F.col("r.rule").alias("rule")).agg(
        F.sum(F.when(hit, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("p") == F.col("r.bit"), F.col("n")).otherwise(0)).alias("n_only_this"))
