"""Packing documents into token sequences: concatenate and cut.

Pass 1 tokenises every document once and keeps its ids as packed binaries in a checkpoint, whose partitions and row order
are fixed from then on. The token totals of the partitions give, by a prefix sum over one number a partition, the place
of each partition in one global token stream. Pass 2 walks each partition from its place and cuts the stream into fixed
windows; a document that crosses a window's edge leaves a piece on either side. Only the last sequence is short.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import accumulate

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import checkpoint, give_back, small_batches, table

VOCABULARY = "byte_bpe_50k"
PIECES = "doc_id string, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


@lru_cache(maxsize=2)
def encoder(name: str = VOCABULARY):
    """text -> ids, the ids that ``tokenizers`` gives for ``<name>.json`` without added special tokens.

    The same vocabulary as ranks runs about four times as fast in tiktoken; texts that hold the string of a special token
    go to ``tokenizers`` itself.
    """
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    with open(public_tokenizers.path(f"{name}.json"), encoding="utf-8") as f:
        special = [t["content"] for t in json.load(f)["added_tokens"]]
    with open(public_tokenizers.path(f"{name}.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding(name, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    @lru_cache(maxsize=1)
    def plain() -> Tokenizer:  # rarely needed, and large
        return Tokenizer.from_file(public_tokenizers.path(f"{name}.json"))

    def encode(text: str) -> list[int]:
        if any(s in text for s in special):
            return plain().encode(text, add_special_tokens=False).ids
        return fast.encode_ordinary(text)

    return encode


def tokenised(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY, end: int = 0) -> DataFrame:
    """(doc_id as text, ids as a binary of little-endian unsigned 16-bit values, n): the ids of each text, then ``end``.

    16 bits hold any id of a vocabulary of at most 65,536 entries; an id of a larger one is refused with an overflow error. As text, null and large doc_ids pass through pandas whole.
    """
    import numpy as np

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = encoder(name)
        for b in batches:
            ids = [np.asarray([*encode(t or ""), end], dtype="<u2") for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "ids": [x.tobytes() for x in ids], "n": [len(x) for x in ids]})
        give_back()

    rows = docs.select(docs[f"`{id_col}`"].cast("string").alias("doc_id"), F.coalesce(docs[f"`{text_col}`"], F.lit("")).alias("text"))
    return rows.mapInPandas(work, "doc_id string, ids binary, n long")


def pack(docs: DataFrame, width: int = 1024, id_col: str = "doc_id", text_col: str = "text", name: str = VOCABULARY, end: int = 0, with_ids: bool = True) -> DataFrame:
    """The pieces of all documents in sequences of ``width`` ids, one row a piece, with the piece's ids (16-bit binary).

    Null text counts as empty: its document is the end id alone. Null and repeated doc_ids are packed like others, a row
    a document. Each id lies in exactly one piece and sequence_id counts from 0 without gaps. An empty table packs to none.
    """
    import numpy as np

    small_batches(docs.sparkSession)
    stream = checkpoint(tokenised(docs, id_col, text_col, name, end)).withColumn("part", F.spark_partition_id())
    totals = {r["part"]: r["n"] for r in stream.groupBy("part").agg(F.sum("n").alias("n")).collect()}  # a number a partition
    parts = sorted(totals)
    place = dict(zip(parts, accumulate((totals[p] for p in parts), initial=0), strict=False))
    places = docs.sparkSession.sparkContext.broadcast(place)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        at = None
        for b in batches:
            rows, pieces = [], []
            for doc, raw, part in zip(b["doc_id"], b["ids"], b["part"], strict=True):
                at = places.value[part] if at is None else at
                ids = np.frombuffer(raw, dtype="<u2")
                wide, n, start = ids.astype("<u4"), len(ids), 0
                while start < n:
                    length = min(n - start, width - at % width)
                    rows.append((doc, start, length, zlib.crc32(wide[start : start + length]), n, at // width, at % width))
                    if with_ids:
                        pieces.append(ids[start : start + length].tobytes())
                    start, at = start + length, at + length
            out = pd.DataFrame(rows, columns=[c.split()[0] for c in PIECES.split(", ")])
            yield out.assign(ids=pieces) if with_ids else out
        give_back()

    pieces = stream.select("doc_id", "ids", "part").mapInPandas(cut, PIECES + (", ids binary" if with_ids else ""))
    return pieces.withColumn("doc_id", F.col("doc_id").cast("long"))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 1024 ids."""
    return pack(table(spark, sf_dir, "documents"), with_ids=False)
