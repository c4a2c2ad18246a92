"""The corpus pipeline: language ID, exact dedup, near dedup, mixing to target weights, packing.

Each stage takes (spark, docs, sf_dir) and works on all that the stage before it kept. All but the last return the columns of
``documents``, and input columns named like an operator's output come through unchanged in the first four stages. An empty
table gives an empty result in every stage. :func:`run` writes each stage's result to the shared folder and reads it again,
so that a lost executor costs one stage's tasks at most and no stage is computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import table, written
from tessera.llm.exact_dedup import exact_dedup
from tessera.llm.language_id import identify
from tessera.llm.mixing import mix_by_source
from tessera.llm.near_dedup import drop_near_duplicates
from tessera.llm.packing import pack

#: The columns that stages read.
OWN, ROW = ("doc_id", "text", "lang", "source"), "__document"


def whole(docs: DataFrame) -> DataFrame:
    """The columns that stages read, and the whole row under one name, so that no name of it meets an operator's."""
    return docs.select(*OWN, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias(ROW))


def rows_of(judged: DataFrame, docs: DataFrame) -> DataFrame:
    return judged.select(*[F.col(ROW)[c].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known.

    Null and empty texts and those without any letter go, and so do texts without a clear language or of a declared language
    that too few rows declare to be modelled. Null languages and sources are no evidence; repeated rows are judged alike;
    of languages with the same posterior the first by code point counts. Very long texts are read whole.
    """
    return rows_of(identify(whole(docs), host_col="source", keep=(ROW,), inside=(ROW, "text")).where("accepted"), docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal texts, white space apart, the one with the most code points stays, then the smallest id.

    Null text counts as empty, and empty texts equal one another; a null id comes last; of rows that repeat wholly one stays.
    """
    return rows_of(exact_dedup(whole(docs), keep=(ROW,)).where("kept"), docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document of the smallest id stays, a null id last; of rows that repeat wholly one.

    Null and empty texts resemble none and stay. Texts of under five words resemble only those of the same words.
    """
    return drop_near_duplicates(docs).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row for each copy that the mix takes of a document, at most two.

    Null and empty texts have no words and go. A null source is a source of its own. Documents with the same id and source are
    taken alike.
    """
    taken = mix_by_source(whole(docs), keep=(ROW,)).where("copies > 0")
    return rows_of(taken.withColumn("copies", F.explode(F.array_repeat(F.lit(1), F.col("copies")))), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 1024 ids: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids.

    A null or empty text is its end id alone; null and repeated ids are packed like others, a row a document.
    """
    return pack(docs)


STAGES = [("language_id", language_id), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("packing", packing)]
#: No SQL expresses the stages; tests hold them against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
