"""Mixing sources by temperature, realised as budgeted permutations of blocks.

The weight of a source is its share of tokens raised to an exponent between 0 (all sources equal) and 1 (as they
are), normalised. The exponent is found by bisection: the largest that reaches an entropy, or the smallest that keeps
repetitions within a limit. Four halvings take one small aggregation over the table of sources, so the number of
sources is not bounded by the driver.

A source's quota is its weight times the budget. Its documents are dealt into blocks by a hash and blocks are taken in
order: whole passes over the source first, then whole blocks of one more pass, then documents of the block where the
quota ends, in hash order, while they fit. What is decided per source is one place in that order, so documents are
compared with it where they are and texts are never shuffled; a hot source is as many blocks as it needs.

Tokens are words ``[^\\x20\\x09-\\x0D]+``. Null text: no tokens. Null source: a source of its own. Sources without any
token give no copies. Rows of equal id stay together, rows without an id those of equal text. Existing columns of the
added names are replaced; others may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from orderlake.llm.frames import privately, table, unused_name, without

WORD = r"[^\x20\x09-\x0D]+"
BLOCK_TOKENS = 100_000  # tokens of a block, unless a source would have more than MOST_BLOCKS
MOST_BLOCKS = 65_536
SEED = "mix-1"
HALVINGS, JOBS = 4, 5
ADDED = ("n_tokens", "weight", "copies")


def _keys(id_col: str, text_col: str, source_col: str) -> dict[str, Column]:
    # Rows without an id go by their text.
    text = F.concat(F.lit(":"), F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    name = F.concat(F.lit(SEED + ":"), F.coalesce(F.col(id_col).cast("string"), text))
    return {
        "_source": F.col(source_col).cast("string"),
        "n_tokens": F.coalesce(F.regexp_count(text_col, F.lit(WORD)), F.lit(0)).cast("bigint"),
        "_order": F.md5(name.cast("binary")),
    }


def _block(order: Column, blocks: Column) -> Column:
    return F.pmod(F.conv(F.substring(order, 1, 8), 16, 10).cast("bigint"), blocks)


def bisect_exponent(
    sources: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
    keep_all: bool = False,
) -> tuple[float, float]:
    """(exponent, normaliser) for a table of sources with their ``share``.

    ``target_entropy`` is a fraction of the entropy of equal weights. With ``keep_all`` repetitions count against the
    largest source taken once, else against a budget of all tokens.
    """
    if (target_entropy is None) == (max_repetition is None):
        raise ValueError("give target_entropy or max_repetition")
    some = sources.where("share > 0")
    n, least, most = some.agg(F.count("*"), F.min("share"), F.max("share")).first()
    if not n:
        return 1.0, 1.0

    def evaluate(exponents: list[float]) -> list[tuple[float, float]]:
        sums = []
        for a in exponents:
            power = F.pow("share", F.lit(a))
            sums += [F.sum(power), F.sum(power * F.log("share"))]
        row = some.agg(*[s.alias(f"s{i}") for i, s in enumerate(sums)]).first()
        return [(row[2 * i], row[2 * i + 1]) for i in range(len(exponents))]

    def too_uneven(a: float, z: float, s: float) -> bool:
        """Whether the weights must be flatter than those of this exponent."""
        if target_entropy is not None:
            return math.log(z) - a * s / z < target_entropy * math.log(n)
        repetition = (most / least) ** (1 - a) if keep_all else least ** (a - 1) / z
        return repetition <= max_repetition  # still allowed, so the exponent may fall

    low, high = 0.0, 1.0
    (z, s), (z0, s0) = evaluate([1.0, 0.0])
    if target_entropy is not None and not too_uneven(1.0, z, s):
        return 1.0, z
    if too_uneven(0.0, z0, s0):
        return 0.0, z0
    for _ in range(JOBS):
        step = (high - low) / (1 << HALVINGS)
        grid = [low + step * i for i in range(1, 1 << HALVINGS)]
        uneven = [too_uneven(a, *x) for a, x in zip(grid, evaluate(grid), strict=True)]
        at = uneven.index(True) if True in uneven else len(grid)
        low, high = low + step * at, low + step * (at + 1)
    exponent = low if target_entropy is not None else high
    return exponent, evaluate([exponent])[0][0]


def plan(
    keyed: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
    budget: int | None = None, keep_all: bool = False,
) -> DataFrame:
    """Per source: ``weight``, ``passes``, ``blocks``, and the block and order up to which one more pass goes."""
    totals = table(keyed.groupBy("_source").agg(F.sum("n_tokens").alias("tokens")), "source-tokens")
    total = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    sources = totals.withColumn("share", F.col("tokens") / F.lit(float(max(total, 1))))
    exponent, norm = bisect_exponent(sources, target_entropy, max_repetition, keep_all)
    weight = F.when(F.col("share") > 0, F.pow("share", F.lit(exponent)) / F.lit(norm)).otherwise(0.0)
    if keep_all:  # tokens / weight is largest for the largest source, whose quota is then one pass
        most = sources.agg(F.max("share")).first()[0] or 0.0
        quota = F.ceil(F.col("tokens") * F.pow(F.lit(most) / F.col("share"), F.lit(1 - exponent)) - F.lit(1e-6))
    else:
        # A quota that is a whole number must not lose a token to rounding.
        quota = F.floor(weight * F.lit(float(total if budget is None else budget)) + F.lit(1e-6))
    size = F.greatest(F.lit(BLOCK_TOKENS), F.ceil(F.col("tokens") / MOST_BLOCKS))
    quotas = sources.select(
        "_source", "tokens", weight.alias("weight"),
        F.when(F.col("tokens") > 0, F.floor(quota / F.col("tokens"))).otherwise(0).cast("bigint").alias("passes"),
        F.when(F.col("tokens") > 0, quota % F.col("tokens")).otherwise(0).cast("bigint").alias("rest"),
        F.greatest(F.lit(1), F.ceil(F.col("tokens") / size)).cast("bigint").alias("blocks"),
    )
    quotas = table(quotas, "quotas")
    named = quotas.withColumnRenamed("_source", "_name")
    placed = keyed.join(named, F.col("_source").eqNullSafe(F.col("_name"))).withColumn(
        "block", _block(F.col("_order"), F.col("blocks"))
    )
    taken = placed.groupBy("_source", "block").agg(F.sum("n_tokens").alias("size"), F.first("rest").alias("rest"))
    before = F.sum("size").over(Window.partitionBy("_source").orderBy("block")) - F.col("size")
    last = (
        taken.withColumn("before", before)
        .where("before <= rest AND before + size > rest")
        .select(F.col("_source").alias("_name"), F.col("block").alias("last_block"), "before")
    )
    last = table(last, "last-blocks")
    inside = placed.select("_source", "_order", "n_tokens", "block", "rest").join(
        last, F.col("_source").eqNullSafe(F.col("_name")) & (F.col("block") == F.col("last_block"))
    )
    upto = F.col("before") + F.sum("n_tokens").over(Window.partitionBy("_source").orderBy("_order"))
    ends = (
        inside.withColumn("upto", upto)
        .where("upto <= rest")
        .groupBy(F.col("_source").alias("_end"))
        .agg(F.max("_order").alias("last_order"))
    )
    return table(
        quotas.join(last.drop("before"), F.col("_source").eqNullSafe(F.col("_name")), "left").drop("_name")
        .join(ends, F.col("_source").eqNullSafe(F.col("_end")), "left").drop("_end"),
        "mix-plan",
    )


def mix_sources(
    docs: DataFrame, target_entropy: float | None = None, max_repetition: float | None = None,
    budget: int | None = None, keep_all: bool = False,
    id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """``docs`` with ``n_tokens``, the ``weight`` of their source and how many ``copies`` the mixture holds.

    ``budget`` is in tokens (all tokens of ``docs`` if not given). ``keep_all`` sets it so that the largest source is
    taken once and no document is left out.
    """
    base, names, name_of = privately(without(docs, ADDED))
    keys = _keys(name_of(id_col), name_of(text_col), name_of(source_col))
    rows = base.withColumns(keys)
    keyed = table(rows.select(*keys), "mix-keys")
    decided = plan(keyed, target_entropy, max_repetition, budget, keep_all).select(
        F.col("_source").alias("_name"), "weight", "passes", "rest", "blocks", "last_block", "last_order"
    )
    block = _block(F.col("_order"), F.col("blocks"))
    once_more = (F.col("rest") > 0) & (
        (block < F.col("last_block")) | ((block == F.col("last_block")) & (F.col("_order") <= F.col("last_order")))
    )
    joined = rows.join(decided, F.col("_source").eqNullSafe(F.col("_name")), "left")
    copies = F.col("passes") + F.coalesce(once_more, F.lit(False)).cast("bigint")
    mixed = joined.select(*names, "n_tokens", "weight", copies.alias("copies"))
    return mixed.toDF(*without(docs, ADDED).columns, *ADDED)


def realise(mixed: DataFrame) -> DataFrame:
    """One row per copy, without the columns that mixing added."""
    copy = unused_name("copy", mixed.columns)
    rows = mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return without(rows, (*ADDED, copy))
