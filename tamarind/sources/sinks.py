"""Writers: snapshots, swapped tables and flat CSV."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tamarind.operators.relations import latest


def _place(spark: SparkSession, path: str):  # noqa: ANN202
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def write_swap(df: DataFrame, path: str) -> None:
    """Replace the Parquet table at ``path`` by ``df``, which may have been read from it.

    The new files are written beside the table and renamed into place. A rename that the file system refuses raises, and the old
    table is put back; the old files are deleted only when the new ones are in place. Between the two renames there is no table
    at ``path``: readers that must not see that need a table format with transactions.
    """
    spark: SparkSession = df.sparkSession
    table, fs = _place(spark, path)
    new, old = _place(spark, f"{path}__new")[0], _place(spark, f"{path}__old")[0]
    if not fs.exists(table) and fs.exists(old) and not fs.rename(old, table):  # a swap that was broken off
        raise OSError(f"cannot restore {path}")
    df.write.mode("overwrite").parquet(f"{path}__new")
    fs.delete(old, True)
    had = fs.exists(table)
    if had and not fs.rename(table, old):
        raise OSError(f"cannot move {path} aside; it is as it was")
    if fs.exists(table) or not fs.rename(new, table):
        if had and not fs.exists(table):
            fs.rename(old, table)
        raise OSError(f"cannot put the new table at {path}; the old one is back")
    fs.delete(old, True)


def write_snapshot(df: DataFrame, folder: str, name: str, at: datetime) -> str:
    """A JSON snapshot under its time, never over an older one; returns its path."""
    path = f"{folder}/{name}_{at.strftime('%Y-%m-%d_%H-%M-%S')}"
    df.write.mode("errorifexists").json(path)
    return path


def append_rows(df: DataFrame, path: str) -> DataFrame:
    """Append rows to a Parquet table; returns the rows that were inserted."""
    df.write.mode("append").parquet(path)
    return df


def write_missing(rows: DataFrame, path: str, keys: list[str]) -> int:
    """Append those rows whose key the table at ``path`` lacks, one a key; returns how many there were."""
    spark = rows.sparkSession
    at, fs = _place(spark, path)
    if fs.exists(at):
        known = spark.read.parquet(path).select(*keys).distinct()
        rows = rows.join(known, keys, "left_anti").select(*rows.columns)
    new = latest(rows, keys, [])
    written = new.persist()
    n = written.count()
    if n:
        written.write.mode("append").parquet(path)
    written.unpersist()
    return n


def run_log(jobs: DataFrame, status: str) -> DataFrame:
    """One row of a run's figures: all jobs, and how many ended in each state."""
    done = lambda s: F.count_if(F.col(status) == s)
    return jobs.agg(F.count("*").alias("total"), done("completed").alias("completed"), done("skipped").alias("skipped"), done("failed").alias("failed"), F.count_if(F.col(status).isNull()).alias("open"))


def flat_columns(df: DataFrame, delimiter: str = " | ") -> DataFrame:
    """Arrays of text joined, maps of text as ``key: value; ...``, other nested values as JSON, all else as it is: what a CSV file can hold."""
    out = []
    for name, kind in df.dtypes:
        if kind == "array<string>":
            out.append(F.array_join(name, delimiter).alias(name))
        elif kind == "map<string,string>":
            pairs = F.transform(F.array_sort(F.map_entries(name)), lambda e: F.concat(e["key"], F.lit(": "), F.coalesce(e["value"], F.lit(""))))
            out.append(F.array_join(pairs, "; ").alias(name))
        elif kind.startswith(("array", "struct", "map")):
            out.append(F.to_json(name).alias(name))
        else:
            out.append(F.col(name))
    return df.select(*out)


def write_csv(df: DataFrame, path: str) -> None:
    """Flat CSV with a header."""
    flat_columns(df).write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
