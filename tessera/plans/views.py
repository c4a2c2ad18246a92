"""The driver's tables as records to be linked, and the tables derived from them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.pairs import set_rows, with_texts
from ..operators.records import normalized
from ..operators.retrieval import QUERY, retrieve
from ..sources.shared import kept

SPACE = r"[ \t\n\x0B\f\r]+"
CAP, K, REL = 50, 10, 0.4
SEEN = 60


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, id, country, text): the source's number picks the source 1 to 3, the language is the country."""
    docs = table(spark, sf_dir, "documents")
    src = (F.substring("source", 4, 9).cast("int") % 3 + 1).cast("byte")
    return docs.select(src.alias("src"), F.col("doc_id").alias("id"), F.col("lang").alias("country"), "text")


def spread(df: DataFrame) -> DataFrame:
    """Rows of a scan with fewer partitions than the cluster has slots, dealt out to all slots; other scans as they are.

    Meant for narrow rows before costly expressions: a small file is one task however many cores there are.
    """
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots else df


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(src, id, entity_id, country, name_raw, addr_raw): name and address are the first 8 words and the next 16.

    Source 1 keeps the smallest id of equal texts of a country; the texts themselves are not shuffled, their digests are.
    """
    docs = documents(spark, sf_dir)
    words = F.filter(F.split("text", SPACE, 26), lambda w: w != "")
    rows = docs.select(
        "src", "id", F.concat(F.lit("S"), F.col("src").cast("string"), F.lit("-"), F.col("id").cast("string")).alias("entity_id"), "country",
        F.array_join(F.slice(words, 1, 8), " ").alias("name_raw"), F.array_join(F.slice(words, 9, 16), " ").alias("addr_raw"),
    )
    rows = spread(rows)
    first = docs.where("src = 1").groupBy("country", F.md5("text")).agg(F.min("id").alias("id")).select("id")
    own = rows.where("src = 1").join(first, "id", "left_semi").select(*rows.columns)
    return own.unionByName(rows.where("src <> 1"))


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared records, computed once and kept: every later step reads them several times."""
    return kept(normalized(raw_records(spark, sf_dir)))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q_src, q_id, s1_id): the smallest entity of the country whose text begins with the same characters."""
    docs = documents(spark, sf_dir).select("src", "id", "country", F.substring("text", 1, SEEN).alias("head"))
    own = docs.where("src = 1").groupBy("country", "head").agg(F.min("id").alias("s1_id"))
    return docs.where("src <> 1").join(own, ["country", "head"]).select(F.col("src").alias("q_src"), F.col("id").alias("q_id"), "s1_id")


def planted_truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """:func:`truth`, and for every seventh query the least entity of its country, which hardly any of them resembles: the
    diagnoses of misses have something to tell."""
    docs = documents(spark, sf_dir).select("src", "id", "country")
    least = docs.where("src = 1").groupBy("country").agg(F.min("id").alias("s1_id"))
    far = docs.where("src <> 1 and id % 7 = 0").join(least, "country").select(F.col("src").alias("q_src"), F.col("id").alias("q_id"), "s1_id")
    return truth(spark, sf_dir).union(far).distinct()


def numbered_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prepared records whose addresses end with a number, as the texts themselves hold hardly any."""
    raw = raw_records(spark, sf_dir)
    return kept(normalized(raw.withColumn("addr_raw", F.concat_ws(" ", "addr_raw", (F.col("id") % 97).cast("string")))))


def candidates(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    return retrieve(records(spark, sf_dir), **({"cap": CAP, "k": K, "rel": REL} | how))


def entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..operators.records import fold_of

    rows = raw_records(spark, sf_dir).where("src = 1")
    return rows.select(F.col("id").alias("s1_id"), "country", fold_of(F.col("id")).alias("fold"))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(q_src, q_id, s1_id, p): a fixed linear score, the mean of retrieval score and two Jaccards (missing: 0)."""
    recs = records(spark, sf_dir)
    rows = set_rows(with_texts(retrieve(recs, cap=CAP, k=K, rel=REL), recs))
    p = F.round((F.col("bscore") + F.greatest("core_jacc", F.lit(0.0)) + F.greatest("addr_jacc", F.lit(0.0))) / 3, 6)
    return rows.select(*QUERY, "s1_id", p.alias("p"))
