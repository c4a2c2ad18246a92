"""Exact deduplication by two-pass Bloom filtering (DataFrame functions only).

Pass 1 hashes each normalised text to two slots of a filter of bounded size and keeps the slots that were hit at least
twice (counts combine on the map side; no text moves). Pass 2 tests each row against the packed filter: rows that miss
are unique for certain and pass straight through; only the others are shuffled and resolved by their SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, checkpoint, join_unique, packed, table, unpacked

#: Upper bound of a filter's slots for each of the two hashes: 2**28 bits, 32 MB each once broadcast. A row without a twin
#: then moves with a chance of (1 - exp(-rows / slots)) ** 2: 0.4 % to 16 million rows, 5 % at 64 million, 40 % at 268 million.
#: Where executors can hold more, raise it: the result is the same at any size.
MAX_SLOTS = 1 << 28
#: Words of 64 bits to a row of the filter, which keeps the broadcast table close to the size of its bits.
PAGE = 64
OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")
#: The characters of the class [\x20\x09-\x0D] (fixed values).
SPACES = (" ", "\t", "\n", "\x0b", "\x0c", "\r")


def without_space(text: Column) -> Column:
    for c in SPACES:
        text = F.replace(text, F.lit(c), F.lit(""))
    return text


def slots_for(rows: int, most: int = MAX_SLOTS) -> int:
    """16 slots a row, a power of two, within the bound; beyond it the filter only passes more rows on to the exact step."""
    return min(most, max(1 << 12, 1 << (16 * max(1, rows) - 1).bit_length()))


def filter_pages(slots: DataFrame) -> DataFrame:
    """(page, words): a bit for each value of the column ``slot``, ``PAGE`` words of 64 to a row; pages without a bit lack."""
    word = F.shiftright("slot", 6)
    words = slots.groupBy(word.alias("word")).agg(F.expr("bit_or(shiftleft(1L, int(slot & 63)))").alias("bits"))
    at = F.pmod("word", F.lit(PAGE)).cast("int")
    pages = words.groupBy(F.floor(F.col("word") / PAGE).cast("long").alias("page")).agg(F.map_from_entries(F.collect_list(F.struct(at.alias("k"), F.col("bits").alias("v")))).alias("m"))  # at most PAGE entries
    return pages.select("page", F.transform(F.sequence(F.lit(0), F.lit(PAGE - 1)), lambda i: F.coalesce(F.try_element_at("m", i), F.lit(0).cast("long"))).alias("words"))


def page_of(slot: str) -> Column:
    return F.floor(F.col(slot) / (64 * PAGE)).cast("long")


def hit(slot: str, words: str) -> Column:
    """Whether the filter's page ``words`` (null: none) has the slot's bit."""
    return F.expr(f"coalesce(getbit({words}[int(shiftright({slot}, 6) % {PAGE})], int({slot} & 63)), 0) = 1")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] | None = None, max_slots: int = MAX_SLOTS) -> DataFrame:
    """Each row of ``docs`` with ``keep_id, group_size, kept, text_sha256``.

    Texts are equal when identical without white space of ``[\\x20\\x09-\\x0D]``. Of equal texts the one with the most code
    points stays, then the smallest id (null last), and of rows that repeat wholly exactly one. Null text counts as empty;
    empty texts equal one another. ``keep`` names the input columns to carry (default all); an input column named like an
    output is replaced. An empty table gives an empty result. No text is moved except those of possible repeats.
    """
    rows = docs.count()
    m = slots_for(rows, max_slots)
    text = F.coalesce(docs[f"`{text_col}`"], F.lit(""))
    base = docs.select(packed(docs, OUTPUT, keep), docs[f"`{id_col}`"].alias("__id"), F.length(text).alias("__n"), F.sha2(without_space(text).cast("binary"), 256).alias("__sha"))
    first = F.pmod(F.xxhash64("__sha"), F.lit(m))
    second = F.pmod(F.xxhash64(F.lit(1), "__sha"), F.lit(m)) + F.lit(m)
    seen = base.select(F.explode(F.array(first, second)).alias("slot"))
    repeated = seen.groupBy("slot").count().where("count > 1").select("slot")
    pages = checkpoint(filter_pages(repeated))  # at most 2 * m bits

    a, b = (F.broadcast(pages.where(side).toDF(f"__p{i}", f"__w{i}")) for i, side in ((1, F.col("page") <= (m - 1) // (64 * PAGE)), (2, F.col("page") >= m // (64 * PAGE))))
    tested = base.withColumn("__s1", first).withColumn("__s2", second)
    tested = tested.join(a, page_of("__s1") == F.col("__p1"), "left").join(b, page_of("__s2") == F.col("__p2"), "left")
    tested = tested.withColumn("__maybe", hit("__s1", "__w1") & hit("__s2", "__w2"))

    alone = tested.where("not __maybe").select(ROW, F.col("__id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), F.col("__sha").alias("text_sha256"))
    maybe = checkpoint(tested.where("__maybe").select(ROW, "__id", "__n", "__sha", F.monotonically_increasing_id().alias("__rid")))
    best = F.min(F.struct(-F.col("__n"), F.col("__id").isNull(), F.col("__id").alias("id"), F.col("__rid").alias("rid")))
    groups = maybe.groupBy("__sha").agg(best.alias("__best"), F.count(F.lit(1)).alias("group_size"))
    solved = join_unique(maybe, groups, "__sha", F.col("group_size"), maybe.count())
    solved = solved.select(ROW, F.col("__best.id").alias("keep_id"), "group_size", (F.col("__best.rid") == F.col("__rid")).alias("kept"), F.col("__sha").alias("text_sha256"))
    out = alone.unionByName(solved)
    return out.select(*unpacked(out), *OUTPUT)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the row that stays for its text."""
    docs = table(spark, sf_dir, "documents")
    return exact_dedup(docs, keep=("doc_id",)).select("doc_id", *OUTPUT)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
h AS (SELECT doc_id, length(t) AS n, sha256(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS text_sha256 FROM d)
SELECT doc_id, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept, text_sha256
FROM h WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id ASC NULLS LAST)
"""
