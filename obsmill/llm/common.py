"""Helpers shared by the corpus operators: scratch tables, hold-outs, bounded samples."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Characters that separate words: space and the ASCII controls tab to carriage return.
SPACES = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"
BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of whole texts: Arrow batches for Python are kept to 1,000 rows where the session names no number."""
    if spark.conf.get(BATCH_ROWS, None) in (None, "10000"):
        spark.conf.set(BATCH_ROWS, "1000")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir. Where it is unset, a temporary one if all runs on this machine, else an error."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/obsmill-checkpoints"
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Scratch:
    """Tables written to the shared folder, so that a lost executor costs no recomputation.

    Leaving the ``with`` block removes the tables made by ``table``; those made by ``result`` back a
    returned DataFrame and go when the application ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.paths = spark, f"{shared_folder(spark)}/obsmill-{name}-{uuid.uuid4().hex}", []

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for path in self.paths:
            remove(self.spark, path)

    def _write(self, df: DataFrame, name: str) -> tuple[str, DataFrame]:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        return path, self.spark.read.schema(df.schema).parquet(path)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path, back = self._write(df, name)
        self.paths.append(path)
        return back

    def drop(self, name: str) -> None:
        """Remove a table that is no longer read."""
        self.paths.remove(f"{self.root}/{name}")
        remove(self.spark, f"{self.root}/{name}")

    def folder(self, name: str) -> str:
        """A folder that the caller writes; it goes with the tables."""
        self.paths.append(f"{self.root}/{name}")
        return self.paths[-1]

    def result(self, df: DataFrame, name: str = "result") -> DataFrame:
        path, back = self._write(df, name)
        atexit.register(remove, self.spark, path)
        return back


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    while name in df.columns:
        name = f"_{name}"
    return name


def id_text(doc_id: str | Column = "doc_id") -> Column:
    return F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("string"), F.lit(""))


def fold(modulus: int, doc_id: str | Column = "doc_id") -> Column:
    """crc32 of the id written as text, modulo ``modulus``; a null id counts as the empty text."""
    return F.pmod(F.crc32(id_text(doc_id).cast("binary")), F.lit(modulus))


def hash_below(most: int, n: int) -> int:
    """The bound below which ``most`` of ``n`` hashes of 63 bits lie on average; exact integers at any count."""
    return (1 << 63) - 1 if n <= most else (most << 63) // n


def bounded_sample(df: DataFrame, by: str, most: int, seed: int = 17) -> DataFrame:
    """Of each value of ``by`` the ``most`` rows with the least hashes (all, where there are no more), equal rows once.

    The hash is of all columns, so that rows that share an id, or have none, are drawn one by one. Rows whose hash
    can't be among the least are passed over by a bound from the (estimated) count of distinct rows, which leaves
    about twice ``most`` rows of a value, whatever the input; these are put in order.
    """
    others = [c for c in df.columns if c != by]
    counts = {r[0]: r[1] for r in df.groupBy(by).agg(F.approx_count_distinct(F.xxhash64(*others))).collect()}
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *others), 1)
    bounds = [F.when(F.col(by) == F.lit(k), draw <= F.lit(hash_below(2 * most + 64, n))) for k, n in counts.items() if k is not None]
    mark, place = fresh(df, "draw"), fresh(df, "place")
    near = df.where(F.coalesce(*bounds, F.lit(False))).distinct().withColumn(mark, draw)
    return near.withColumn(place, F.row_number().over(Window.partitionBy(by).orderBy(mark, *others))).where(F.col(place) <= most).drop(mark, place)
