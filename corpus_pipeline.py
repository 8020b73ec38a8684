"""A corpus cleaned, deduplicated, mixed and tokenised: five stages over ``documents``.

Each stage takes the documents its predecessor kept, as a Parquet table, and returns those it keeps; all but the last
return the columns they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlake.llm.frames import table, unused_name
from orderlake.llm.mixing import mix_sources, realise
from orderlake.llm.piece_codec import encode
from orderlake.llm.prob_minhash import near_duplicates
from orderlake.llm.quality_rules import STANDARD, judge, ledger
from orderlake.llm.queries import PIECE_MODEL, ship_package
from orderlake.llm.substring_dedup import remove_repeats


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail a rule of the standard policy go."""
    return judge(ledger(docs), STANDARD).where("kept").select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near duplicates one row stays: that of the smallest id, then text digest; so does each row
    without an id. A text is judged by itself also where its id has other texts.
    """
    ship_package(spark)
    row = unused_name("row", docs.columns)
    numbered = table(docs.where("doc_id IS NOT NULL").withColumn(row, F.monotonically_increasing_id()), "rows")
    classes = near_duplicates(numbered.select("doc_id", "text", row), id_col=row, threshold=0.8)
    order = F.struct("doc_id", F.sha2("text", 256), row)
    first = classes.groupBy("class_id").agg(F.min(order).alias("first")).select(F.col(f"first.{row}").alias(row))
    kept = numbered.join(first, row, "left_semi").select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 13 words and more that an earlier document has are cut out; what is emptied goes.

    Texts that lose nothing are left as they are; of the others the kept words are joined by one space.
    """
    ship_package(spark)
    cut = remove_repeats(docs, window=13).where("n_removed = 0 OR n_removed < n_words")
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    changed = {"text": text, "n_chars": F.when(F.col("n_removed") > 0, F.length(text)).otherwise(F.col("n_chars"))}
    return cut.select(*[changed[c].alias(c) if c in changed else F.col(c) for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources are repeated, up to one and a half times; every document stays."""
    return realise(mix_sources(docs, max_repetition=1.5, keep_all=True))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text."""
    ship_package(spark)
    coded = encode(docs.select("doc_id", "lang", "source", "text"), PIECE_MODEL)
    return coded.select("doc_id", "lang", "source", F.size("piece_ids").cast("bigint").alias("n_tokens"), "piece_ids")


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("substring_dedup", substring_dedup),
    ("mix", mix),
    ("tokenise", tokenise),
]

#: Near duplicates by signatures, and pieces, cannot be said in SQL; tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
