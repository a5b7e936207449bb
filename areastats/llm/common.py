"""Helpers that the corpus operators share."""

import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

#: Bounds of one slice that a task works on at a time, whatever the size of an Arrow batch.
SLICE_ROWS, SLICE_CHARS = 512, 2_000_000


def shared_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder that the driver and all executors see; removed when the driver's JVM ends.

    It lies in `spark.checkpoint.dir`, or where that is unset (tests) in the warehouse. On a
    cluster, a warehouse on the driver's own disk is refused.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    folder = f"{(shared or spark.conf.get('spark.sql.warehouse.dir')).rstrip('/')}/corpus-{name}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if shared is None and files.getScheme() == "file" and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    files.deleteOnExit(path)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back: computed once, lineage cut."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def filesystem(uri: str):
    """Arrow file system and path of a folder of `shared_folder`; used inside tasks."""
    from pyarrow import fs

    if uri.startswith("file:"):
        uri = "file:///" + uri[5:].lstrip("/")
    if "://" not in uri:
        uri = "file://" + os.path.abspath(uri)
    return fs.FileSystem.from_uri(uri)


def slices(batch: pa.RecordBatch, text: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Cut a batch into slices of bounded rows and characters, with their texts (null: empty)."""
    texts = [t or "" for t in batch.column(text).to_pylist()]
    start = chars = 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= SLICE_ROWS or chars + len(t) > SLICE_CHARS):
            yield batch.slice(start, i - start), texts[start:i]
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield batch.slice(start), texts[start:]


def schema_of(df: DataFrame, *added: tuple[str, T.DataType]) -> T.StructType:
    """Schema of a frame with further columns."""
    return T.StructType([*df.schema.fields, *(T.StructField(n, t) for n, t in added)])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that the frame does not have yet, whatever its case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def numbered(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """The rows, stored, with a number of their own in a new column; and that column's name.

    The number is drawn once, before the rows are stored, so all later readers see the same.
    """
    column = fresh(df, "row_number_of_" + name)
    return stored(df.withColumn(column, F.monotonically_increasing_id()), name), column


def settled_labels(labels: DataFrame, label: str) -> DataFrame:
    """(label_id, label): one label of each doc_id; of conflicting ones the largest. Rows with a null are left out."""
    rows = labels.select(F.col("doc_id").cast("long").alias("label_id"), F.col(label).cast("int").alias("label")).dropna()
    return rows.groupBy("label_id").agg(F.max("label").alias("label"))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo `parts`; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(parts))


def hashed_share(column: Column, seed: int) -> Column:
    """A uniform number in [0, 1) that depends on the value and the seed only."""
    return F.pmod(F.xxhash64(column, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)


def bounded_sample(df: DataFrame, key: str, rows: int, seed: int = 17, strata: str | None = None) -> DataFrame:
    """About `rows` rows (of each stratum) by hash of the key; all of them where there are fewer.

    One light pass counts rows; texts outside the sample are not shuffled.
    """
    share = hashed_share(F.col(key), seed)
    if strata is None:
        n = df.count()
        return df if n <= rows else df.where(share < rows / n)
    counts = {r[0]: r[1] for r in df.groupBy(strata).count().collect()}  # one row per label value
    keep = F.lit(False)
    for value, n in counts.items():
        keep = keep | ((F.col(strata) == F.lit(value)) & (share < F.lit(min(1.0, rows / n))))
    return df.where(keep)
