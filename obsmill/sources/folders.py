"""Folders of one file (or Parquet folder) a station: scanning, conversion, digests and schemas of files."""

from __future__ import annotations

import atexit
import contextlib
import csv
import re
import tempfile
import uuid

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from obsmill.sources.tables import ABSENT

#: A station's folder has eleven letters or digits; as a path pattern, folders of other names aren't even listed.
STATION = "[A-Za-z0-9]" * 11
NAME = "[A-Za-z0-9]{11}"


def work_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, or a temporary one where all runs on this machine."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = f"file://{tempfile.gettempdir()}/obsmill-checkpoints"
    path = f"{root.rstrip('/')}/obsmill-{name}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def _station(path: Column | str, file_name: str) -> Column:
    return F.regexp_extract(path, rf"/({NAME})/{file_name.replace('.', '[.]')}(?:/|$)", 1)


def discover(spark: SparkSession, root: str, file_name: str) -> DataFrame:
    """(station_id, n_files, size_bytes) of stations that have the file; contents aren't read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.*").load(f"{root}/{STATION}/{file_name}").select("path", "length")
    return files.groupBy(_station("path", file_name).alias("station_id")).agg(F.count("*").alias("n_files"), F.sum("length").alias("size_bytes"))


def scan(spark: SparkSession, root: str, file_name: str, ids: list[str] | None = None) -> DataFrame:
    """The rows of all stations' Parquet files (or of those named) with station_id from the folder's name; unlike schemas are joined by name.

    Names go into the path pattern, so that other stations' files aren't listed. A condition on the files' paths
    would be checked row by row. Files and folders of none of the names are an error of the reader.
    """
    if ids is not None and (wrong := [x for x in ids if not re.fullmatch(NAME, x)]):
        raise ValueError(f"not station names: {', '.join(wrong)}")
    which = STATION if ids is None else f"{{{','.join(ids)}}}"
    rows = spark.read.option("mergeSchema", True).parquet(f"{root}/{which}/{file_name}")
    return rows.withColumn("station_id", _station(F.col("_metadata.file_path"), file_name))


def headers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(path, header): the first line of each text file."""
    lines = spark.read.text(paths).where(F.col("_metadata.file_block_start") == 0)
    return lines.select(F.col("_metadata.file_path").alias("path"), "value", F.monotonically_increasing_id().alias("nth")).groupBy("path").agg(F.min_by("value", "nth").alias("header"))


def read_csv_folder(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """All files' rows as text by the union of their headers, absent cells as null, with _path. Files are read together by header."""
    by: dict[str, list[str]] = {}
    for path, header in headers(spark, paths).orderBy("path").collect():
        by.setdefault(header, []).append(path)
    out = None
    for header, files in by.items():
        names = next(csv.reader([header]))
        rows = spark.read.schema(T.StructType([T.StructField(c, T.StringType()) for c in names])).csv(files, header=True, escape='"')
        part = rows.select(*[F.when(~F.col(f"`{c}`").isin(*ABSENT), F.col(f"`{c}`")).alias(c) for c in names], F.col("_metadata.file_path").alias("_path"))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise FileNotFoundError(f"no text files under {paths}")
    return out


def as_text(df: DataFrame, keep: tuple[str, ...] = ("string", "boolean", "int", "bigint", "double", "float", "date", "timestamp")) -> DataFrame:
    """df with columns that a Parquet table of plain columns can't hold, such as arrays and maps, as text (JSON); null stays null."""
    made = {c: F.to_json(c) if t.startswith(("array", "map", "struct")) else F.col(c).cast("string") for c, t in df.dtypes if t not in keep}
    return df.withColumns(made) if made else df


def convert_csv(spark: SparkSession, root: str, file_name: str, target: str) -> DataFrame:
    """Each station's CSV as Parquet under target/station_id=<id>, in one job; (station_id, n_rows) of what was written, read back."""
    rows = read_csv_folder(spark, f"{root}/{STATION}/{file_name}")
    as_text(rows.withColumn("station_id", _station("_path", file_name)).drop("_path")).write.mode("overwrite").partitionBy("station_id").parquet(target)
    schema = rows.drop("_path").schema.add("station_id", "string")
    return spark.read.schema(schema).parquet(target)


def contents(spark: SparkSession, root: str, most: int = 256 << 20) -> DataFrame:
    """(path, length, content) of the files under root, paths from there; content is null beyond ``most`` bytes, which aren't read.

    Spark's readers pass over empty files, so these aren't here.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    tail = "/" + root.split("://")[-1].strip("/").split("/", 1)[-1] + "/"
    relative = F.expr(f"substring(path, instr(path, '{tail}') + {len(tail)})")
    small = files.where(F.col("length") <= most).select(relative.alias("path"), "length", "content")
    return small.unionAll(files.where(F.col("length") > most).select(relative, "length", F.lit(None).cast("binary")))


def digests(files: DataFrame) -> DataFrame:
    """(path, length, checksum): SHA-256 of a file's bytes and a zero byte, as manifests of one file have it."""
    return files.select("path", "length", F.sha2(F.concat("content", F.lit(b"\0")), 256).alias("checksum"))


def conformance(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """(artifact_id, path, state): ok, missing (or empty), altered, or unread where a file was too large to be read."""
    f = found.select("path", F.col("checksum").alias("actual"), F.lit(True).alias("there"))
    state = F.when(F.col("there").isNull(), "missing").when(F.col("actual").isNull(), "unread").when(F.col("actual").eqNullSafe(F.col("checksum")), "ok").otherwise("altered")
    return manifest.select("artifact_id", "path", "checksum").join(f, "path", "left").select("artifact_id", "path", state.alias("state"))


def schema_rows(files: DataFrame) -> DataFrame:
    """(path, columns) of Parquet files, from the files' own footers, wherever they lie."""

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def parquet_columns(content: pd.Series) -> pd.Series:
        import pyarrow as pa
        import pyarrow.parquet as pq

        return pd.Series([None if c is None else pq.read_schema(pa.BufferReader(c)).names for c in content], dtype=object)

    return files.where(F.col("path").endswith(".parquet")).select("path", parquet_columns("content").alias("columns"))


def schema_deviations(schemas: DataFrame, key: str = "path", columns: str = "columns") -> DataFrame:
    """(key, n_columns, missing, added, reordered) of schemas that differ from the first one's in the order of key."""
    first = schemas.orderBy(key).select(columns).first()
    reference = F.array(*map(F.lit, first[0] if first else [])).cast("array<string>")
    now = F.col(columns)
    missing, added = F.array_sort(F.array_except(reference, now)), F.array_sort(F.array_except(now, reference))
    same = (F.size(now) == F.size(reference)) & (F.size(missing) == 0) & (F.size(added) == 0)
    return schemas.where(~now.eqNullSafe(reference)).select(key, F.size(now).alias("n_columns"), missing.alias("missing"), added.alias("added"), same.alias("reordered"))
