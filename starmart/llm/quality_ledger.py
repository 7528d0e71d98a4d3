"""Quality rules as a ledger: each rule is evaluated once, its failure is a bit, its measurement a column.

Policies are versioned masks over the ledger, so a new policy or an ablation never reads a text again. DataFrame
and SQL functions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from uuid import uuid4

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed values of the base rules.
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "[#*$%&|<>]"
WHITE = "[ \\t-\\r]+"
BLACK = "[^ \\t-\\r]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")


@dataclass(frozen=True)
class Rule:
    """Fails where `fails`, SQL over the measurements, is true; null counts as passed."""

    name: str
    fails: str


@dataclass(frozen=True)
class Policy:
    """A document is kept if none of the named rules fails it."""

    version: str
    rules: tuple[str, ...]


#: Bit k of a ledger is rule k. Rules are only ever appended, so that old ledgers keep their meaning.
RULES = (
    Rule("too_few_words", f"n_words < {MIN_WORDS}"),
    Rule("repeated_words", f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words"),
    Rule("too_many_symbols", "10 * n_symbols > n_words"),
    Rule("words_too_short", "word_chars < 2 * n_words"),
    Rule("words_too_long", "word_chars > 20 * n_words"),
    Rule("repeated_lines", "10 * n_dup_lines > 3 * n_lines"),
)
BASE = Policy("base", ("too_few_words", "repeated_words"))
V1 = Policy("v1", (*BASE.rules, "too_many_symbols", "words_too_short", "words_too_long"))
V2 = Policy("v2", tuple(r.name for r in RULES))
CURRENT = V1


def mask(policy: Policy, rules: Sequence[Rule] = RULES) -> int:
    bits = {r.name: 1 << k for k, r in enumerate(rules)}
    return sum(bits[name] for name in policy.rules)


# A window's hash above its position, in one long: sorting plain longs brings equal windows together. The position
# takes as many bits as the number of words has, the hash the rest; equal hashes are confirmed by their words.
WINDOWS = """CASE WHEN n_words >= 3 THEN sort_array(transform(sequence(0, CAST(n_words AS INT) - 3),
  i -> shiftleft(xxhash64(get(__w, i), get(__w, i + 1), get(__w, i + 2)), __bits) | CAST(i AS BIGINT))) END"""

FOUND_AGAIN = "(k > 0 AND {}) OR {}".format(
    *[
        f"""((get(__s, {other}) ^ x) & ~__low = 0
          AND get(__w, CAST(get(__s, {other}) & __low AS INT)) = get(__w, CAST(x & __low AS INT))
          AND get(__w, CAST(get(__s, {other}) & __low AS INT) + 1) = get(__w, CAST(x & __low AS INT) + 1)
          AND get(__w, CAST(get(__s, {other}) & __low AS INT) + 2) = get(__w, CAST(x & __low AS INT) + 2))"""
        for other in ("k - 1", "k + 1")
    ]
)
REPEATED = f"""sort_array(filter(
  transform(__s, (x, k) -> CASE WHEN {FOUND_AGAIN} THEN CAST(x & __low AS INT) END), p -> p IS NOT NULL))"""

COVERED = """coalesce(aggregate(
  transform(__p, (p, k) -> CAST(least(3, coalesce(get(__p, k + 1) - p, 3)) AS BIGINT)), 0L, (a, x) -> a + x), 0L)"""


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines and n_repeat_words (long).

    A null text has no words and measures zero throughout. n_lines counts the lines with a word, n_dup_lines those
    equal to an earlier one. n_repeat_words counts the words inside any window of three words that occurs
    twice or more in the text. Columns of these names in `docs` are replaced. Everything happens within a row: no
    shuffle, and a text of n words sorts n longs.
    """
    whole = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.drop(*MEASURES).withColumns(
        {
            "__w": F.array_remove(F.split(whole, WHITE), ""),
            "__l": F.filter(F.split(whole, "\n"), lambda line: line.rlike(BLACK)),
            "n_symbols": (F.length(whole) - F.length(F.regexp_replace(whole, SYMBOLS, ""))).cast("long"),
        }
    )
    rows = rows.withColumns(
        {
            "n_words": F.size("__w").cast("long"),
            "word_chars": F.length(F.array_join("__w", "")).cast("long"),
            "n_lines": F.size("__l").cast("long"),
            "n_dup_lines": (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long"),
            "__bits": F.length(F.bin(F.size("__w").cast("long"))).cast("int"),
        }
    )
    rows = rows.withColumns({"__s": F.expr(WINDOWS), "__low": F.expr("shiftleft(1L, __bits) - 1L")})
    rows = rows.withColumn("__p", F.expr(REPEATED))
    return rows.withColumn("n_repeat_words", F.expr(COVERED)).drop("__w", "__l", "__bits", "__s", "__low", "__p")


def ledger(docs: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of `docs` with the measurements and `failed_bits`, bit k set where rule k fails.

    Rows and failures per rule are counted on the way, under a name of their own in the query's observed metrics. That
    also keeps a filter on the verdict above the measurements: pushed below, it would evaluate them many times.
    """
    rows = measured(docs, text)
    bits = F.lit(0).cast("long")
    for k, rule in enumerate(rules):
        bits = bits.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)).cast("long"))
    judged = rows.withColumn("failed_bits", bits)
    failed = [F.count_if(F.col("failed_bits").bitwiseAND(F.lit(1 << k)) != 0).alias(r.name) for k, r in enumerate(rules)]
    return judged.observe(f"quality-{uuid4()}", F.count(F.lit(1)).alias("documents"), *failed)


def verdict(rows: DataFrame, policy: Policy = CURRENT, name: str = "kept", rules: Sequence[Rule] = RULES) -> DataFrame:
    """A ledger with the boolean verdict of a policy."""
    return rows.withColumn(name, F.col("failed_bits").bitwiseAND(F.lit(mask(policy, rules))) == 0)


def ablations(rows: DataFrame, policy: Policy = CURRENT, rules: Sequence[Rule] = RULES) -> DataFrame:
    """(rule, failed, failed_alone, kept_without) for each rule of a policy.

    Documents are counted per pattern of bits first, at most 2**rules rows; each rule is then read off the
    patterns: how many it fails, how many it alone fails, and how many would be kept without it. An empty ledger
    gives zeros.
    """
    whole = mask(policy, rules)
    named = [(r.name, 1 << k) for k, r in enumerate(rules) if r.name in policy.rules]
    pattern = F.col("failed_bits").bitwiseAND(F.lit(whole))
    counts = rows.groupBy(pattern.alias("pattern")).agg(F.count("*").alias("n"))

    def total(which):
        return F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0)).cast("long")

    seen = [
        F.struct(
            F.lit(name).alias("rule"),
            total(F.col("pattern").bitwiseAND(F.lit(bit)) != 0).alias("failed"),
            total(F.col("pattern") == bit).alias("failed_alone"),
            total(F.col("pattern").bitwiseAND(F.lit(whole & ~bit)) == 0).alias("kept_without"),
        )
        for name, bit in named
    ]
    return counts.agg(F.array(*seen).alias("all")).select(F.inline("all"))
