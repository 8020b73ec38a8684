"""Quality rules as a ledger of failure bits: every rule is evaluated once, policies choose among the bits later.

``ledger`` adds the measurements of each text and one integer whose bit *i* says that rule *i* failed. A policy is a
version and a mask of the bits that reject a document; applying another version, or asking what dropping a rule would
bring back (``ablations``), never reads a text again. Built-in functions only: no Python touches a row, nothing is
shuffled but the few bit patterns of the ablations.

Null or empty text: no words, so it fails ``too_few_words``. Windows of three words are compared by a 64-bit hash
within their text. Existing columns of the added names are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlake.llm.frames import privately, without

WORD = r"[^\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MEASURES = ("n_words", "word_chars", "n_symbols", "n_exclaims", "n_lines", "n_dup_lines", "n_repeat_words")

# Rule by bit, lowest first: name and the condition under which a text fails.
RULES = (
    ("too_few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("many_symbols", "10 * n_symbols > n_words"),
    ("many_exclaims", "4 * n_exclaims > n_words"),
    ("duplicate_lines", "n_dup_lines >= 3 AND 100 * n_dup_lines > 30 * n_lines"),
    ("odd_word_length", "word_chars > 15 * n_words OR word_chars < 2 * n_words"),
)
BITS = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version and the rules that reject a document under it."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return sum(BITS[r] for r in self.rules)


BASE = Policy("base", ("too_few_words", "repeated_windows"))
STANDARD = Policy("standard-1", tuple(BITS))


def _count_of(text: Column, chars: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, chars, ""))).cast("bigint")


def measured(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the measurements of each text."""
    base, names, name_of = privately(without(df, MEASURES))
    kept = [F.col(c) for c in names]
    text = F.coalesce(F.col(name_of(text_col)), F.lit(""))
    # One projection for each array that is read more than once: it is computed there and nowhere else.
    words = base.select(*kept, F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("_words"))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(F.translate(line, SPACES, "")) > 0)
    at = F.when(F.size("_words") >= 3, F.sequence(F.lit(0), F.size("_words") - 3)).otherwise(
        F.array().cast("array<int>")
    )
    window = F.transform(
        at, lambda i: F.struct(F.xxhash64(*[F.get("_words", i + j) for j in range(3)]).alias("h"), i.alias("i"))
    )
    windows = words.select(
        *kept,
        F.size("_words").cast("bigint").alias("n_words"),
        F.length(F.translate(text, SPACES, "")).cast("bigint").alias("word_chars"),
        _count_of(text, SYMBOLS).alias("n_symbols"),
        _count_of(text, "!").alias("n_exclaims"),
        lines.alias("_lines"),
        F.sort_array(window).alias("_windows"),
    )
    repeated = F.filter(
        "_windows",
        lambda x, j: (x["h"] == F.get("_windows", j - 1)["h"]) | (x["h"] == F.get("_windows", j + 1)["h"]),
    )
    places = windows.select(
        *kept, "n_words", "word_chars", "n_symbols", "n_exclaims",
        F.size("_lines").cast("bigint").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(F.transform(repeated, lambda x: x["i"])).alias("_places"),
    )
    # A repeated window covers three words, or as many as there are before the next one begins.
    covered = F.zip_with("_places", F.expr("slice(_places, 2, greatest(size(_places), 1))"),
                         lambda a, b: F.least(F.lit(3), b - a))
    total = F.aggregate(covered, F.lit(0).cast("bigint"), lambda n, x: n + x)
    # In a generator: a filter on a measurement would else be pushed below the projections above, which are then
    # written out inside its lambdas and computed for every word.
    order = [*[m for m in MEASURES if m != "n_repeat_words"], "n_repeat_words"]
    found = F.struct(*order[:-1], total.alias("n_repeat_words"))
    return places.select(*kept, F.inline(F.array(found))).toDF(*without(df, MEASURES).columns, *order)


def ledger(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with measurements and ``failures``, the bits of the rules each text fails."""
    found = measured(without(df, ["failures"]), text_col)
    bits = [F.when(F.expr(condition), F.lit(BITS[name])).otherwise(F.lit(0)) for name, condition in RULES]
    total = bits[0]
    for bit in bits[1:]:
        total = total.bitwiseOR(bit)
    return found.withColumn("failures", total)


def passes(policy: Policy) -> Column:
    return F.col("failures").bitwiseAND(F.lit(policy.mask)) == 0


def judge(book: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """A ledger with the verdict of a policy: ``kept`` and ``policy_version``."""
    return book.withColumns({"kept": passes(policy), "policy_version": F.lit(policy.version)})


def ablations(book: DataFrame, policy: Policy = STANDARD) -> DataFrame:
    """Per rule of a policy: documents failing it, failing nothing else (back without it), and failing any rule."""
    failing = F.col("failures").bitwiseAND(F.lit(policy.mask)).alias("bits")
    patterns = book.select(failing).groupBy("bits").agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(BITS[r]).alias("bit")) for r in policy.rules]))
    return (
        patterns.select("bits", "n", rules.alias("r"))
        .groupBy(F.col("r.rule").alias("rule"))
        .agg(
            F.sum(F.when(F.expr("bits & r.bit != 0"), F.col("n")).otherwise(0)).alias("n_failed"),
            F.sum(F.when(F.expr("bits = r.bit"), F.col("n")).otherwise(0)).alias("n_only"),
            F.sum(F.when(F.expr("bits != 0"), F.col("n")).otherwise(0)).alias("n_rejected"),
        )
        .withColumn("policy_version", F.lit(policy.version))
    )
