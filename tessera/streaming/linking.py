"""Linking of arriving queries against a fixed entity table, micro-batch by micro-batch.

Retrieval and assignment look at one query at a time, so each batch is linked by itself and the results of all batches equal
those of one run over all queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.assign import assign, best_per_query
from ..operators.retrieval import CAP, retrieve


def link(records: DataFrame, t: float = 0.6, margin: float = 0.2, cap: int = CAP) -> DataFrame:
    cands = retrieve(records, cap=cap)
    return assign(best_per_query(cands.withColumnRenamed("bscore", "p")), t, margin)


def link_stream(entities: DataFrame, arriving: DataFrame, out_path: str, checkpoint_path: str, **how):
    """Starts the stream; each batch is written under its number, so a batch run again after a failure replaces itself."""

    def one(batch: DataFrame, number: int) -> None:
        link(entities.unionByName(batch), **how).write.mode("overwrite").parquet(f"{out_path}/batch={number}")

    return arriving.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint_path).trigger(availableNow=True).start()
