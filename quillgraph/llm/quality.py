"""Quality rules as a bitmask ledger, in DataFrame functions alone.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for each rule failed.
Policies are versioned masks over those bits, so a verdict, a new policy or an ablation needs no second look at a text.

Nulls, empties: a null or empty text has no words; its counts are 0 and it fails `few_words`. Repeated rows are judged
each for itself, of equal lines the first is no duplicate, and whole texts count: a text stands in one row with a list of its words. Columns of the input other than doc_id and text are not read, so their names can't clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, word_list

#: Rules in bit order; a bit never changes its meaning, new rules get new bits.
RULES: dict[str, str] = {
    "few_words": "n_words < 50",
    "repeated_words": "100 * n_repeat_words > 50 * n_words",
    "symbols": "10 * n_symbols > 3 * n_words",
    "duplicate_lines": "100 * n_dup_lines > 30 * n_lines",
    "short_words": "10 * word_chars < 15 * n_words",
    "long_words": "word_chars > 20 * n_words",
}
BIT = {name: 1 << k for k, name in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version's name and the rules whose failure rejects a document."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BIT[r] for r in self.rules)


BASE = Policy("base-1", ("few_words", "repeated_words"))
PROSE = Policy("prose-1", tuple(RULES))


def _windows(words: Column) -> Column:
    """Hash of every 3-word window; null for fewer words."""
    at = F.sequence(F.lit(0), F.size(words) - 3)
    return F.when(F.size(words) >= 3, F.transform(at, lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2))))


def _covered(hashes: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more: equal hashes stand side by side once sorted and mark their
    positions; each marked window then adds the words that the marked one before it did not reach, three at most.
    """
    ordered = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    same = lambda s, i, j: F.get(s, i)["h"].eqNullSafe(F.get(s, j)["h"])
    marked = F.transform(F.array(ordered), lambda s: F.sort_array(F.transform(F.filter(F.transform(s, lambda x, i: F.when(same(s, i, i - 1) | same(s, i, i + 1), x["i"])), lambda p: p.isNotNull()), lambda p: F.coalesce(p, F.lit(0)))))
    one = F.get(marked, 0)
    return F.aggregate(
        one,
        F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
        lambda acc, p: F.struct((acc["n"] + F.least(F.lit(3), p - acc["last"])).alias("n"), p.alias("last")),
        lambda acc: acc["n"],
    )


def measure(docs: DataFrame) -> DataFrame:
    """doc_id and the measurements: n_words, word_chars, n_symbols, n_lines (with a word), n_dup_lines, n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    split = docs.select("doc_id", text.alias("_t"), word_list(text).alias("_w"), F.filter(F.split(text, "\n", -1), lambda x: F.regexp_replace(x, SPACE + "+", "") != "").alias("_l"))
    hashed = split.withColumn("_h", _windows(F.col("_w")))
    long = lambda c: c.cast("bigint")
    return hashed.select(
        "doc_id",
        long(F.size("_w")).alias("n_words"),
        long(F.length(F.translate("_t", " \t\n\x0b\f\r", ""))).alias("word_chars"),
        long(F.length("_t") - F.length(F.translate("_t", "#*$%&|<>", ""))).alias("n_symbols"),
        long(F.size("_l")).alias("n_lines"),
        long(F.size("_l") - F.size(F.array_distinct("_l"))).alias("n_dup_lines"),
        # a set of plain longs, in compiled code, tells whether anything repeats; only then is there a sort
        long(F.when(F.col("_h").isNull() | (F.size(F.array_distinct("_h")) == F.size("_h")), F.lit(0)).otherwise(_covered(F.col("_h")))).alias("n_repeat_words"),
    )


def ledger(docs: DataFrame) -> DataFrame:
    """measure() and failed, a bigint with the bit of every rule that the document fails."""
    bits = [F.when(F.expr(rule), F.lit(BIT[name])).otherwise(F.lit(0)) for name, rule in RULES.items()]
    mask = bits[0]
    for b in bits[1:]:
        mask = mask.bitwiseOR(b)
    return measure(docs).withColumn("failed", mask.cast("bigint"))


def apply_policy(entries: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """entries with a boolean column: none of the policy's rules failed."""
    return entries.withColumn(name, F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablation(entries: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: how many it fails, how many it alone fails, how many pass without it. One aggregation of bits."""
    left = F.col("failed").bitwiseAND(F.lit(policy.mask))
    cells = []
    for r in policy.rules:
        bit = F.lit(BIT[r])
        cells.append(F.struct(
            F.lit(r).alias("rule"),
            F.count_if(left.bitwiseAND(bit) != 0).alias("n_failed"),
            F.count_if(left == bit).alias("n_only"),
            F.count_if(left.bitwiseAND(F.lit(policy.mask & ~BIT[r])) == 0).alias("n_kept_without"),
        ))
    return entries.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select(F.lit(policy.version).alias("policy"), "x.*")


def verdicts(docs: DataFrame, policy: Policy = PROSE) -> DataFrame:
    """The ledger with base_failed, and kept: false where the base rules fail, else the policy's verdict."""
    out = apply_policy(apply_policy(ledger(docs), BASE, "_base"), policy, "_kept")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", (~F.col("_base")).alias("base_failed"), (F.col("_base") & F.col("_kept")).alias("kept"), "failed", F.lit(policy.version).alias("policy"))
