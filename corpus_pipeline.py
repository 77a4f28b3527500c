"""The corpus pipeline: documents through five operators, each stage a table of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import jaccard, lines, mix, pieces, rules
from terrace.llm.queries import piece_model, table
from terrace.llm.text import stored


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor those learned from the labels reject.

    Null and empty texts have too few words and go, as do all short ones; rows that
    repeat are judged alike, texts are judged whole, an empty table stays empty.
    """
    return rules.keep_good(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without chunks of lines that stand earlier in the corpus.

    No row goes; null texts stay null, what is left empty is the empty text. Rows
    alike in doc_id and text are treated alike, an empty table stays empty.
    """
    left = lines.dedup(docs).drop("n_chunks", "n_removed")
    return left.withColumn("n_chars", F.length("text").cast("long"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates.

    The smallest doc_id stays (null last), of rows alike in doc_id and text the first
    by all columns. Null, empty and blank texts are in no group and stay.
    """
    return jaccard.keep_one(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it.

    Documents without words are not taken; a null source is one of its own; rows
    alike in doc_id, source and text are one document. An empty table stays empty.
    """
    return mix.mixed(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each text, and the digest of the text they decode to.

    One row for each; null and empty texts have the end id alone.
    """
    coded = pieces.encode(docs.select("doc_id", "lang", "source", "text"), piece_model())
    return coded.select(
        "doc_id",
        "lang",
        "source",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", near_duplicates),
    ("mixing sources", mixing),
    ("SentencePiece encoding", encoding),
]

#: Learned rules, components, Newton steps and merge rounds are not for SQL; tests hold it against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents, each written and read by the next.

    Nulls, empty and very long texts, ties and repeated rows are borne as each
    stage says; an empty table gives an empty one. Further columns are kept up to
    the last stage, but for those named like what line dedup adds.
    """
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
