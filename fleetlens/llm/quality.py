"""Quality rules as a bitmask ledger.

Every rule is evaluated once per text. The ledger keeps the measurements and one 64-bit mask of failed rules; policies
are versioned masks over it, so changing a policy, or asking what a rule costs, never reads a text again.

Repeats inside a text are found in its row: windows of five words become 64-bit hashes (of the words' hashes), and only
texts whose windows are not all distinct are looked at closer. No text leaves its row and no shuffle is needed.

Defined results: NULL text has no words and no lines and fails the rules for short texts; lines without a word are no
lines; texts of any length are measured whole; measurements of repeated rows are equal; extra columns are kept, columns
named as measurements are replaced.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlens.llm.common import WORD

WINDOW = 5
# Characters that count as symbols, and the white space between words.
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\f\r"

MEASUREMENTS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_chars")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` is the rule's place in the mask and never reused."""

    bit: int
    name: str
    fails: str


# The ledger's rules. New rules get new bits; thresholds live here, choices between rules in POLICIES.
RULES = (
    Rule(0, "few_words", "n_words < 10"),
    Rule(1, "repeated_passages", "100 * n_repeat_words > 20 * n_words"),
    Rule(2, "many_symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 AND 2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "shouting", "n_words >= 10 AND 2 * n_upper > n_chars"),
    Rule(7, "no_words", "n_words = 0"),
    Rule(8, "few_words_strict", "n_words < 50"),
    Rule(9, "any_repeated_line", "n_dup_lines > 0"),
)

# Policy versions: the names of the rules that reject.
POLICIES: Mapping[str, Sequence[str]] = {
    "base": ("few_words", "repeated_passages"),
    "v1": ("few_words", "repeated_passages", "many_symbols", "repeated_lines", "short_words", "long_words", "shouting"),
    "strict": tuple(r.name for r in RULES),
}


def mask_of(policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> int:
    names = POLICIES[policy] if isinstance(policy, str) else policy
    bits = {r.name: 1 << r.bit for r in rules}
    return sum(bits[n] for n in set(names))


def _shifted(values: Column, by: int, n: Column) -> Column:
    return F.slice(values, F.lit(1 + by), n)


def measured(df: DataFrame, text: str = "text") -> DataFrame:
    """Add the measurements of every text."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n", -1), lambda line: line.rlike(WORD))
    df = df.withColumns({
        "__llm_words": F.transform(F.regexp_extract_all(t, F.lit(WORD), F.lit(0)), lambda w: F.xxhash64(w)),
        "__llm_lines": lines,
        "word_chars": F.length(F.translate(t, BLANKS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
        "n_upper": F.length(F.regexp_replace(t, r"\P{Lu}+", "")).cast("long"),
        "n_chars": F.length(t).cast("long"),
    })
    df = df.withColumns({
        "n_words": F.size("__llm_words").cast("long"),
        "n_lines": F.size("__llm_lines").cast("long"),
        "n_dup_lines": (F.size("__llm_lines") - F.size(F.array_distinct("__llm_lines"))).cast("long"),
        "__llm_n": F.greatest(F.size("__llm_words") - (WINDOW - 1), F.lit(0)),
    })
    parts = [_shifted(F.col("__llm_words"), k, F.col("__llm_n")) for k in range(WINDOW)]
    df = df.withColumn("__llm_windows", F.transform(F.arrays_zip(*parts), lambda s: F.xxhash64(s)))
    repeats = F.size(F.array_distinct("__llm_windows")) < F.size("__llm_windows")
    # (hash, place), sorted; only for texts that hold a repeat
    places = F.when(repeats, F.array_sort(F.arrays_zip(
        F.col("__llm_windows").alias("h"), F.sequence(F.lit(0), F.col("__llm_n") - 1).alias("i"))))
    df = df.withColumn("__llm_sorted", places)
    hashes = F.transform(F.col("__llm_sorted"), lambda s: s["h"])
    df = df.withColumn("__llm_hashes", hashes)
    none = F.array(F.lit(None).cast("long"))
    neighbours = F.arrays_zip(
        F.col("__llm_sorted").alias("s"),
        F.concat(none, F.slice("__llm_hashes", F.lit(1), F.size("__llm_hashes") - 1)).alias("before"),
        F.concat(F.slice("__llm_hashes", F.lit(2), F.size("__llm_hashes")), none).alias("after"),
    )
    again = F.filter(neighbours, lambda x: x["s"]["h"].eqNullSafe(x["before"]) | x["s"]["h"].eqNullSafe(x["after"]))
    df = df.withColumn("__llm_places", F.sort_array(F.transform(again, lambda x: x["s"]["i"])))
    # Each repeated window covers its words up to the next one's first word.
    gaps = F.zip_with(
        F.col("__llm_places"), F.slice("__llm_places", F.lit(2), F.size("__llm_places")),
        lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW))))
    covered = F.aggregate(gaps, F.lit(0), lambda acc, g: acc + g)
    df = df.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
    return df.drop("__llm_words", "__llm_lines", "__llm_n", "__llm_windows", "__llm_sorted", "__llm_hashes", "__llm_places")


def ledger(df: DataFrame, text: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """Add the measurements and ``failures``, the mask of failed rules."""
    failures = F.lit(0).cast("long")
    for r in rules:
        failures = failures.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measured(df, text).withColumn("failures", failures)


def rejected(policy: str | Sequence[str], rules: Sequence[Rule] = RULES, failures: str = "failures") -> Column:
    """Whether the policy rejects a row of the ledger."""
    return F.col(failures).bitwiseAND(F.lit(mask_of(policy, rules)).cast("long")) != 0


def keep(df: DataFrame, policy: str | Sequence[str], text: str = "text") -> DataFrame:
    """The rows that the policy keeps, with the columns of ``df``."""
    marked = ledger(df.withColumn("__llm_row", F.struct(*df.columns)), text)
    # A filter would be pushed below the measurements and compute them again; a generator is not.
    return marked.select(F.inline(F.when(~rejected(policy), F.array("__llm_row"))))


def ablations(entries: DataFrame, policy: str | Sequence[str], rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: rows it fails, rows only it rejects, rows kept with the policy and without the rule.

    Works on the ledger alone: one count per distinct mask, then bitwise tests on the masks.
    """
    whole = mask_of(policy, rules)
    chosen = [r for r in rules if whole >> r.bit & 1]
    masks = entries.groupBy(F.col("failures").bitwiseAND(F.lit(whole).cast("long")).alias("mask")).agg(
        F.count(F.lit(1)).alias("n"))
    rule = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit")) for r in chosen]))
    spread = masks.withColumn("r", rule).select("mask", "n", "r.*")
    fails, alone = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask") == F.col("bit")
    count = lambda which: F.coalesce(F.sum(F.when(which, F.col("n"))), F.lit(0))
    return spread.groupBy("rule").agg(
        count(fails).alias("failed"), count(alone).alias("only_this"), count(F.col("mask") == 0).alias("kept"),
        count((F.col("mask") == 0) | alone).alias("kept_without"))
