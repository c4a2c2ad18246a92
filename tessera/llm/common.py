"""What the training-data operators share: checkpoints, row packing, joins that bear a hot key."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ROW = "__row"
#: A key holding more than this share of the rows is hot; there are at most ``1 / HOT_SHARE`` such keys.
HOT_SHARE = 0.001
BATCH_ROWS = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def checkpoint(df: DataFrame) -> DataFrame:
    """Eager reliable checkpoint in the shared folder of ``spark.checkpoint.dir``.

    A temporary folder is used only where the session names none and is local, as in tests; on a cluster that is an error.
    """
    sc = df.sparkSession.sparkContext
    if sc.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not named and not sc.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="tessera-checkpoint-"))
    return df.checkpoint()


def packed(df: DataFrame, drop: tuple[str, ...] = (), keep: tuple[str, ...] | None = None) -> Column:
    """All input columns as one struct, so that no name of theirs meets an internal one.

    ``drop`` names the operator's output columns; an input column of that name is replaced by the output.
    """
    names = [c for c in (df.columns if keep is None else keep) if c not in drop]
    return F.struct(*[df[f"`{c}`"] for c in names]).alias(ROW) if names else F.struct(F.lit(0).alias("__none")).alias(ROW)


def unpacked(df: DataFrame) -> list[Column]:
    """The columns packed by :func:`packed`, in their order."""
    fields = [f.name for f in df.schema[ROW].dataType.fields]
    return [F.col(ROW)[f].alias(f) for f in fields if f != "__none"]


def settled(df: DataFrame, rows_a_part: int = 20_000) -> tuple[DataFrame, int]:
    """A checkpoint and its rows, read in as few partitions as they fill, but no fewer than the cluster's slots.

    What follows a small result then writes few files, however many partitions the session shuffles by.
    """
    out = checkpoint(df)
    rows, parts = out.count(), out.rdd.getNumPartitions()
    few = max(-(-rows // rows_a_part), out.sparkSession.sparkContext.defaultParallelism)
    return (out.coalesce(few) if few < parts else out), rows


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of at most ``BATCH_ROWS`` rows from now on in this session; smaller settings stay.

    Texts are read whole, so the default of 10,000 rows takes hundreds of MB in each Python worker, kept while it idles.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name, "10000")) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def give_back() -> None:
    """Returns a Python worker's free memory to the system; workers outlive their task and idle beside the executor's heap."""
    import ctypes
    import gc

    import pyarrow

    gc.collect()
    pyarrow.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def written(df: DataFrame) -> DataFrame:
    """The rows as Parquet in the shared folder, read again; for wide rows, which compress well there."""
    spark = df.sparkSession
    checkpoint(spark.range(0))  # makes sure of the folder
    path = f"{spark.sparkContext.getCheckpointDir()}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def join_unique(left: DataFrame, right: DataFrame, key: str, rows: Column, total: int, how: str = "inner") -> DataFrame:
    """Join many-to-one on ``key`` where a key may hold a third of the left rows.

    ``right`` has one row a key and ``rows`` is the left rows of that key. Keys with more than ``HOT_SHARE`` of ``total``
    number at most ``1 / HOT_SHARE``, so that part is broadcast under a proven bound and its left rows stay where they are;
    only the rest is shuffled, and none of its keys is large. A ``how`` of ``left`` keeps left rows without a partner.
    """
    hot = F.coalesce(rows > F.lit(max(1.0, HOT_SHARE * total)), F.lit(False))
    big = F.broadcast(right.where(hot))
    near = left.join(big, key)
    far = left.join(F.broadcast(right.where(hot).select(key)), key, "left_anti").join(right.where(~hot), key, how)
    return near.unionByName(far)
