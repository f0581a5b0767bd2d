"""Corpus pipeline over documents: toxic texts, near copies, long repeats and benchmark leaks go, the rest is mixed.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each to the shared folder as Parquet and
reads it again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tagpulse.llm import decontaminate, mixing, simhash, suffix, toxicity
from tagpulse.llm.common import materialize, table
from tagpulse.llm.minhash import Rule


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels"))


#: Near copies share five-word shingles at a similarity of 0.8 or more.
NEAR = Rule(shingle=5, percent=80)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.deduplicate(docs, similar=NEAR)


#: Passages of 50 words are meant. Strings of 200 bytes find them where a word and its space take four bytes or more; runs of
#: such strings that hold fewer words stay.
REPEAT_BYTES, REPEAT_GRAM, REPEAT_WORDS = 200, 64, 50


def cut_long_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts lose their repeated passages, n_chars follows; documents of which nothing stays remain as empty texts."""
    cut = suffix.cut_repeats(docs, length=REPEAT_BYTES, gram=REPEAT_GRAM, min_words=REPEAT_WORDS, prefix="_cut_")
    length = F.when(F.col("_cut_n_removed") > 0, F.length("_cut_kept")).otherwise(F.col("n_chars"))
    return cut.withColumn("text", F.col("_cut_kept")).withColumn("n_chars", length.cast("long")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes words of, with size, source_size, target and taken.

    Rows that repeat a document's id, source and text share what the mix takes of them, the first ones one word more.
    """
    key = ["doc_id", "source", "text_hash"]
    each = mixing.mix(docs).groupBy(*key).agg(*[F.first(c).alias(c) for c in ("size", "source_size", "target")], F.sum("taken").alias("taken"), F.count("*").alias("_n"))
    each = each.where("taken > 0").withColumnsRenamed({"doc_id": "_id", "source": "_source", "text_hash": "_hash"})
    kept = docs.select(*[c for c in docs.columns if c not in ("size", "source_size", "target", "taken")])
    turn = Window.partitionBy("doc_id", "source", F.xxhash64("text")).orderBy(F.xxhash64(*kept.columns))
    kept = kept.withColumn("_turn", F.row_number().over(turn))
    same = kept["doc_id"].eqNullSafe(each["_id"]) & kept["source"].eqNullSafe(each["_source"]) & (F.xxhash64(kept["text"]) == each["_hash"])
    share = F.expr("taken div _n + if(_turn <= taken % _n, 1, 0)")
    return kept.join(each, same).withColumn("taken", share).where("taken > 0").drop("_id", "_source", "_hash", "_n", "_turn")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", cut_long_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("mix_sources", mix_sources),
]

#: None: trained models, XXH64 fingerprints and SimHash windows cannot be said in DuckDB SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir))
    return docs
