"""Files: verbatim TSV, result lists, JSON documents, appended logs, resumable tables."""

from __future__ import annotations

import csv
import io
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW = T.StructType([T.StructField(c, T.StringType()) for c in ("entity_id", "business_name", "business_address", "country")])


def _file(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _file(spark, path)
    return fs.exists(p)


def read_tsv(spark: SparkSession, path: str, schema: T.StructType = RAW) -> DataFrame:
    """All columns as strings, verbatim: no quoting or escapes, an empty field is an empty string."""
    df = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("mode", "PERMISSIVE").csv(path)
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


def write_tsv(df: DataFrame, path: str) -> None:
    """Strings verbatim, each part with a header, no quoting or escapes; what :func:`read_tsv` reads."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("emptyValue", "").csv(path)


def raw_records(raw: DataFrame, src: int) -> DataFrame:
    """The record columns of a raw table of one source."""
    from ..operators.records import parse_id

    return raw.select(F.lit(src).cast("byte").alias("src"), parse_id(F.col("entity_id"))[1].alias("id"), "entity_id", "country", F.col("business_name").alias("name_raw"), F.col("business_address").alias("addr_raw"))


def truth_pairs(raw: DataFrame) -> DataFrame:
    """(q_src, q_id, s1_id) of rows (source1_entity_id, matched_entity_ids)."""
    from ..operators.records import parse_id

    each = raw.select(parse_id(F.col("source1_entity_id"))[1].alias("s1_id"), F.explode(F.filter(F.split("matched_entity_ids", ","), lambda x: x != "")).alias("id"))
    src, number = parse_id(F.col("id"))
    return each.select(src.alias("q_src"), number.alias("q_id"), "s1_id")


def must_exist(truth: DataFrame, records: DataFrame) -> DataFrame:
    """``truth``, if each of its ids is one of the records'; else an error that names a few that are not."""
    ids = truth.select(F.explode(F.array(F.struct(F.lit(1).cast("int").alias("src"), F.col("s1_id").alias("id")), F.struct(F.col("q_src").cast("int").alias("src"), F.col("q_id").alias("id")))).alias("x")).select("x.*").distinct()
    lost = ids.join(records.select(F.col("src").cast("int").alias("src"), "id"), ["src", "id"], "left_anti").orderBy("src", "id").limit(5).collect()
    if lost:
        raise ValueError(f"ids of the truth that no record has: {[f'S{r['src']}-{r['id']}' for r in lost]}")
    return truth


def id_lists(pairs: DataFrame, entities: DataFrame, column: str = "matched_entity_ids") -> DataFrame:
    """A row for every entity, with its queries' ids sorted by source and number, without repeats, comma-joined; maybe empty."""
    ids = F.transform(F.array_sort(F.collect_set(F.struct("q_src", "q_id"))), lambda x: F.concat(F.lit("S"), x["q_src"].cast("string"), F.lit("-"), x["q_id"].cast("string")))
    lists = pairs.groupBy("s1_id").agg(F.array_join(ids, ",").alias(column))
    return entities.join(lists, "s1_id", "left").select("s1_id", F.concat(F.lit("S1-"), F.col("s1_id").cast("string")).alias("source1_entity_id"), F.coalesce(column, F.lit("")).alias(column))


def write_lists(lists: DataFrame, path: str) -> None:
    """TSV with a header, UTF-8, LF, in order of the entities; parts sorted by range, not one task."""
    names = [c for c in lists.columns if c != "s1_id"]
    lists.orderBy("s1_id").select(*names).write.mode("overwrite").option("sep", "\t").option("header", True).option("quote", "").option("escape", "").option("emptyValue", "").csv(path)


def write_list_file(lists: DataFrame, path: str) -> None:
    """:func:`write_lists` as one file with one header, as validators of single files want it. The parts are written by all
    tasks and then joined in order as streams of bytes, so that no row passes through the driver's memory."""
    spark = lists.sparkSession
    parts = f"{path}.parts"
    names = [c for c in lists.columns if c != "s1_id"]
    lists.orderBy("s1_id").select(*names).write.mode("overwrite").option("sep", "\t").option("quote", "").option("escape", "").option("emptyValue", "").csv(parts)
    folder, fs = _file(spark, parts)
    begun, _ = _file(spark, f"{path}.begun")
    hadoop, conf = spark.sparkContext._jvm.org.apache.hadoop, spark.sparkContext._jsc.hadoopConfiguration()
    out = fs.create(begun, True)
    try:
        out.write(bytearray(("\t".join(names) + "\n").encode()))
        for at in sorted(str(f.getPath()) for f in fs.listStatus(folder)):
            if at.rsplit("/", 1)[-1].startswith("part-"):
                part = fs.open(_file(spark, at)[0])
                try:
                    hadoop.io.IOUtils.copyBytes(part, out, conf, False)
                finally:
                    part.close()
    finally:
        out.close()
    target, _ = _file(spark, path)
    fs.delete(target, True)
    fs.rename(begun, target)
    fs.delete(folder, True)


def read_lists(spark: SparkSession, path: str) -> DataFrame:
    """(s1, ids) of lines as they stand, for validation; ids is null where a line has no tab. The header line is dropped."""
    lines = spark.read.text(path)
    parts = F.split("value", "\t", 2)
    return lines.where(~F.lower("value").startswith("source1_entity_id\t")).select(parts[0].alias("s1"), F.get(parts, F.lit(1)).alias("ids"))


def header_of(spark: SparkSession, path: str) -> str:
    """'ok', 'missing', 'empty', 'comma' or 'wrong' for the first line of a list file."""
    if not exists(spark, path):
        return "missing"
    first = spark.read.text(path).limit(1).collect()
    if not first:
        return "empty"
    line = first[0]["value"].strip().lower()
    if "\t" not in line:
        return "comma" if "," in line else "wrong"
    return "ok" if line.split("\t") in (["source1_entity_id", "matched_entity_ids"], ["source1_entity_id", "candidate_entity_ids"]) else "wrong"


def resumable(spark: SparkSession, path: str, make, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """The table at ``path``, made first unless a finished one is there; the commit protocol makes it appear whole."""
    if not exists(spark, f"{path}/_SUCCESS"):
        make().write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)


def top_up(spark: SparkSession, path: str, wanted: DataFrame, key: list[str], make) -> DataFrame:
    """A keyed table extended by ``make`` of the keys it lacks; nothing is computed twice."""
    have = exists(spark, f"{path}/_SUCCESS")
    new = wanted.join(spark.read.parquet(path).select(*key), key, "left_anti") if have else wanted
    if not new.isEmpty():
        make(new).write.mode("append").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path).join(wanted.select(*key).distinct(), key, "left_semi")


def write_json(spark: SparkSession, path: str, value: object) -> None:
    p, fs = _file(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(json.dumps(value, sort_keys=True).encode()))
    finally:
        out.close()


def read_json(spark: SparkSession, path: str) -> object:
    return json.loads("\n".join(r["value"] for r in spark.read.text(path).collect()))


def append_log(spark: SparkSession, path: str, row: dict, columns: list[str]) -> None:
    """One line more in a CSV log of one file; columns the row lacks are empty. The new log takes the old one's place whole."""
    have = "\n".join(r["value"] for r in spark.read.text(path).collect()) + "\n" if exists(spark, path) else ""  # a line an experiment
    text = io.StringIO(newline="")
    sheet = csv.DictWriter(text, columns, lineterminator="\n", extrasaction="ignore")
    if not have:
        sheet.writeheader()
    sheet.writerow({c: "" if row.get(c) is None else row[c] for c in columns})
    write_text(spark, path, have + text.getvalue())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    begun, fs = _file(spark, f"{path}.begun")
    out = fs.create(begun, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    target, _ = _file(spark, path)
    fs.delete(target, False)
    fs.rename(begun, target)


def markdown(df: DataFrame, title: str) -> str:
    """An aggregate of a few rows as a Markdown table; the caller bounds its rows."""
    rows = df.collect()
    line = lambda xs: "| " + " | ".join("" if x is None else str(x) for x in xs) + " |"
    return "\n".join([f"## {title}", "", line(df.columns), line("---" for _ in df.columns), *(line(r) for r in rows), ""])
