"""Quality rules as a ledger: every rule is evaluated once per document, the
failures are kept as bits beside the measurements, and policies and ablations
read the bits only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from platelake.llm.text import SPACES, let, positions, space_words, whole

WINDOW = 5
SYMBOL = r"[#*$%&|<>]"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
            "n_lines", "n_upper", "n_marks")


def _rules() -> dict[str, Column]:
    """What makes a document fail, on the measurements. Order gives the bit."""
    n, chars = F.col("n_words"), F.col("word_chars")
    return {
        "few_words": n < 10,
        "repeated_words": 100 * F.col("n_repeat_words") > 20 * n,
        "symbols": 10 * F.col("n_symbols") > n,
        "repeated_lines": 100 * F.col("n_dup_lines") > 50 * F.col("n_lines"),
        "word_length": (chars < 2 * n) | (chars > 20 * n),
        "upper_case": 2 * F.col("n_upper") > chars,
        "marks": 2 * F.col("n_marks") > n,
    }


RULES = ("few_words", "repeated_words", "symbols", "repeated_lines", "word_length",
         "upper_case", "marks")
BASE_RULES = ("few_words", "repeated_words")

# Versioned policies: the rules whose failure rejects a document.
POLICIES: dict[str, tuple[str, ...]] = {
    "base": BASE_RULES,
    "v1": (*BASE_RULES, "symbols", "repeated_lines", "word_length"),
    "v2": RULES,
}
POLICY = "v2"


def mask(rules: Sequence[str]) -> int:
    """The bits of the named rules."""
    return sum(1 << RULES.index(r) for r in rules)


def _repeated_words(words: Column) -> Column:
    """Words inside windows of five words that occur again in the text.

    Windows are compared by their 64-bit hash. Only texts with a repeated hash
    go on to sort their windows; a run of sorted starts then gives the covered
    words without marking them one by one.
    """
    def cover(starts: Column) -> Column:
        reach = F.transform(starts, lambda p, k: F.least(
            F.lit(WINDOW), F.coalesce(F.get(starts, k + 1) - p, F.lit(WINDOW))))
        return F.aggregate(reach, F.lit(0).cast("long"), lambda a, x: a + x)

    def repeated(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = let(placed, lambda s: F.filter(s, lambda e, k: (
            F.coalesce(F.get(s, k - 1)["h"] == e["h"], F.lit(False))
            | F.coalesce(F.get(s, k + 1)["h"] == e["h"], F.lit(False)))))
        starts = F.sort_array(F.transform(again, lambda e: e["i"]))
        return F.when(
            F.size(F.array_distinct(hashes)) < F.size(hashes), let(starts, cover)
        ).otherwise(F.lit(0).cast("long"))

    hashes = let(words, lambda w: F.transform(
        positions(F.size(w) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(w, i + 1, WINDOW))))
    return let(hashes, repeated)


def measure(docs: DataFrame, text: str = "text", row: str = "row") -> DataFrame:
    """One row per document: the whole input row as a struct, so that no
    column of it can clash, and the measurements. A null text has no words,
    no lines and measures zero throughout."""
    lines = F.filter(
        F.split(F.col("_text"), "\n"), lambda x: F.char_length(F.btrim(x, F.lit(SPACES))) > 0)

    def count(pattern: str) -> Column:
        return F.size(F.regexp_extract_all(F.col("_text"), F.lit(pattern), F.lit(0)))

    listed = docs.select(F.struct("*").alias(row), whole(text).alias("_text")).select(
        row, "_text", space_words(F.col("_text")).alias("_words"), lines.alias("_lines"))
    measured = listed.select(
        row,
        F.size("_words").alias("n_words"),
        F.char_length(F.array_join("_words", "")).alias("word_chars"),
        count(SYMBOL).alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).alias("n_dup_lines"),
        _repeated_words(F.col("_words")).alias("n_repeat_words"),
        F.size("_lines").alias("n_lines"),
        F.char_length(F.regexp_replace("_text", "[^A-Z]+", "")).alias("n_upper"),
        count("!").alias("n_marks"),
    )
    return measured.select(row, *[F.col(c).cast("long").alias(c) for c in MEASURES])


def ledger(docs: DataFrame, text: str = "text", row: str = "row") -> DataFrame:
    """Measurements and ``fail_bits``: bit i is set if the i-th rule fails.

    Rows are independent: repeated rows and repeated ids give repeated
    results, an empty table gives an empty ledger.
    """
    rules = _rules()
    bits = [F.when(rules[name], F.lit(1 << i)).otherwise(F.lit(0)) for i, name in enumerate(RULES)]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return measure(docs, text, row).withColumn("fail_bits", total.cast("long"))


def passes(rules: Sequence[str], bits: str = "fail_bits") -> Column:
    """Whether none of the rules has failed."""
    return F.col(bits).bitwiseAND(F.lit(mask(rules)).cast("long")) == 0


def apply_policies(
    entries: DataFrame, policies: Mapping[str, Sequence[str]] = POLICIES
) -> DataFrame:
    """Adds ``kept_<version>`` for each policy. No rule is evaluated again."""
    return entries.withColumns({f"kept_{v}": passes(rules) for v, rules in policies.items()})


def ablations(entries: DataFrame, policy: Sequence[str] = RULES) -> DataFrame:
    """What each rule of a policy does, from the bits alone.

    Per rule: documents that fail it, documents that fail nothing else of the
    policy, documents kept if it were left out, and the bits that its failures
    have in common or show at all. There are at most 2 ** rules patterns of
    bits, so everything after the first sum is tiny however large the ledger.
    An empty ledger gives a row of zeros and nulls per rule.
    """
    whole_mask = F.lit(mask(policy)).cast("long")
    patterns = entries.groupBy(F.col("fail_bits").bitwiseAND(whole_mask).alias("bits")).agg(
        F.count(F.lit(1)).alias("n"))
    named = entries.sparkSession.createDataFrame(
        [(r, mask([r])) for r in policy], "rule string, bit long")
    # The rules stand on the left, so each has a row even if nothing is there.
    paired = F.broadcast(named).select("rule", "bit", F.lit(1).alias("_all"))
    summed = patterns.agg(F.collect_list(F.struct("bits", "n")).alias("patterns")).select(
        "patterns", F.lit(1).alias("_all"))
    rows = paired.join(summed, "_all").select("rule", "bit", F.explode_outer("patterns").alias("p"))
    bits, n = F.col("p.bits"), F.col("p.n")
    failed = bits.bitwiseAND(F.col("bit")) != 0
    alone = bits == F.col("bit")
    without = bits.bitwiseAND(whole_mask - F.col("bit")) == 0

    def total(where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, n)), F.lit(0)).cast("long")

    return rows.groupBy("rule").agg(
        total(failed).alias("n_failed"), total(alone).alias("n_only"),
        total(without).alias("n_kept_without"),
        F.bit_and(F.when(failed, bits)).alias("bits_always"),
        F.bit_or(F.when(failed, bits)).alias("bits_ever"),
    )


def with_ablations(entries: DataFrame, policy: Sequence[str] = RULES) -> DataFrame:
    """Adds what the policy would do without a rule to the documents that this
    rule alone rejects: ``only_rule``, and ``kept_without``, how many documents
    the policy would keep then. Both are null for all other documents.

    ``entries`` should be a written table: it is read twice, and no rule is
    evaluated again. What is joined has a row per rule.
    """
    own = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    only = F.lit(None).cast("string")
    for rule in policy:
        only = F.when(own == mask([rule]), F.lit(rule)).otherwise(only)
    without = ablations(entries, policy).select(
        F.col("rule").alias("only_rule"), F.col("n_kept_without").alias("kept_without"))
    return entries.withColumn("only_rule", only).join(F.broadcast(without), "only_rule", "left")


def keep(docs: DataFrame, policy: Sequence[str] = POLICIES[POLICY], text: str = "text") -> DataFrame:
    """The documents that pass a policy, with their own columns."""
    return ledger(docs, text).where(passes(policy)).select("row.*")
