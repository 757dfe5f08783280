"""A corpus from documents to a training mix, in five stages; each stage's result is written and read again by the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import decontaminate, langid, linededup, minhash, mixing
from tidemark.llm.common import bounded_batches, finished, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language was found; a null language becomes the found one.

    Null and empty texts, and texts without a letter, go. Rows that repeat are judged alike; a text of any length is read whole; of
    equally good languages the first by name counts. Other columns, whatever their names, stay.
    """
    bounded_batches(spark)
    return langid.accepted(docs, langid.learned(docs))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of passages go; documents of which nothing else remains go with them; n_chars becomes the new length.

    The place that stays is the first by doc_id (null first), then by place. Rows that repeat id and text are one document; null and
    empty texts stay as they are. Other columns, whatever their names, stay.
    """
    bounded_batches(spark)
    out = linededup.cleaned(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*[F.col(f"`{c}`") for c in docs.columns])


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id.

    Documents without words (null and empty texts) and without an id stay; rows that repeat an id stay or go together. Other columns,
    whatever their names, stay.
    """
    bounded_batches(spark)
    gone = minhash.near_duplicates(docs).where("NOT kept").select("doc_id")
    return docs.join(gone, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item.

    Null and empty texts hold none; documents without an id stay, as no finding can name them; rows that repeat an id stay or go
    together. Other columns, whatever their names, stay.
    """
    found = decontaminate.leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id")
    return docs.join(found, "doc_id", "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents drawn for the mix, with their topic, n_tokens, weight and probability; columns named so are replaced.

    Texts without words are never drawn; null sources and languages are categories of their own; rows of one id and cell are drawn
    together.
    """
    bounded_batches(spark)
    return mixing.mix(docs).where("sampled").drop("sampled")


STAGES = [("language_id", language), ("line_dedup", lines), ("near_dedup", near), ("decontamination", benchmark), ("mixing", mixture)]

#: Viterbi paths, winnowing and signatures are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = finished(lambda f=stage, d=docs: f(spark, d, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
