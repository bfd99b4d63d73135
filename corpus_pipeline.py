"""The corpus pipeline: quality rules, line dedup, near duplicates, benchmark decontamination, token ids.

Every stage takes (spark, docs, sf_dir), works on all documents that the one
before it kept, and returns a DataFrame that `run` writes as Parquet and reads
again. All but the last return the columns of documents; where a stage changes
a text, `n_chars` (if there is such a column) follows it. Columns of other
names pass through.

A null text has no words and goes with the first stage, as an empty one does; an
empty table passes through all stages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.llm import pieces
from corvane.llm.contamination import decontaminate
from corvane.llm.line_templates import drop_recurring_lines, line_words
from corvane.llm.quality import judge_text
from corvane.llm.similar import one_of_each
from corvane.llm.tables import table
from corvane.session import configure, shared_folder

MIN_WORDS = 10


def _packed(docs: DataFrame) -> DataFrame:
    """doc_id, text, others: the other columns in one struct, where no name of theirs clashes with an operator's."""
    others = [F.col(f"`{c}`").alias(c) for c in docs.columns if c not in ("doc_id", "text")]
    return docs.select("doc_id", "text", F.struct(F.lit(None).cast("int").alias("none"), *others).alias("others"))


def _unpacked(packed: DataFrame, columns: list[str], text_changed: bool = False) -> DataFrame:
    """The named columns again; where the text has another one, `n_chars` is its length."""
    own = {"doc_id": F.col("doc_id"), "text": F.col("text")}
    if text_changed:
        own["n_chars"] = F.length("text").cast("long")
    return packed.select(*(own.get(c, F.col("others").getField(c)).alias(c) for c in columns))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the quality rules keep, without their failing lines.

    `inline` has each text judged once; a filter on the verdict as a column would judge it again.
    """
    configure(spark)
    row = _packed(docs).select(F.struct("doc_id", "others").alias("row"), F.inline(F.array(judge_text(F.col("text")))))
    kept = row.where("kept").select("row.doc_id", "text", "row.others")
    return _unpacked(kept, docs.columns, text_changed=True)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without lines that recur (long ones in two texts, short ones in ten documents); those of which fewer than ten words are left go."""
    kept = drop_recurring_lines(_packed(docs), keep_lines="lost")
    enough = F.size(line_words(F.col("text"))) >= MIN_WORDS
    return _unpacked(kept.where((F.size("lost") == 0) | enough), docs.columns, text_changed=True)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that similarities of 0.8 on five words link."""
    configure(spark)
    return _unpacked(one_of_each(_packed(docs), n=5, percent=80), docs.columns)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents in which no ten words in a row come from a benchmark item."""
    return _unpacked(decontaminate(_packed(docs), table(spark, sf_dir, "benchmark"), n=10), docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens, text: the SentencePiece ids and what they decode to."""
    import public_tokenizers

    configure(spark)
    vocabulary = pieces.load_vocabulary(public_tokenizers.path("piece_bpe_32k.model"))
    encoded = docs.select("doc_id", "lang", "source", pieces.round_trip(F.col("text"), vocabulary).alias("r"))
    return encoded.select("doc_id", "lang", "source", "r.ids", F.size("r.ids").cast("long").alias("n_tokens"), "r.text")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("token ids", token_ids),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{number}")
        docs = spark.read.parquet(f"{folder}/{number}")
    return docs


# SentencePiece has no form in SQL; tests/llm/test_pipeline.py compares the stages with brute force.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
SQL: dict[str, str] = {}
