"""Versioned snapshots: a table is a folder of numbered versions and a pointer that is replaced in one step."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm


def current_version(spark: SparkSession, root: str) -> int | None:
    """The highest version that was published; None for a new table."""
    p, fs, _ = _fs(spark, root)
    if not fs.exists(p):
        return None
    done = [int(s.getPath().getName()[9:]) for s in fs.listStatus(p) if s.getPath().getName().startswith("published")]
    return max(done, default=None)


def read_current(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    v = current_version(spark, root)
    return None if v is None else spark.read.parquet(f"{root}/v{v}")


def _claim(spark: SparkSession, root: str) -> int:
    """A version number that no other writer has: a marker is made for it, which only one writer can do."""
    v = current_version(spark, root) or 0
    while True:
        v += 1
        p, fs, _ = _fs(spark, f"{root}/claim{v}")
        try:
            fs.create(p, False).close()
            return v
        except Exception:
            if not fs.exists(p):
                raise


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None) -> int:
    """Claim the next version, write it, then publish it with an empty marker file: readers see the old or the new one,
    never a part, and two writers never write one version. A version whose writer was lost stays unpublished."""
    spark = df.sparkSession
    v = _claim(spark, root)
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{root}/v{v}")
    p, fs, _ = _fs(spark, f"{root}/published{v}")
    fs.create(p, False).close()
    return v


def drop_old(spark: SparkSession, root: str, keep: int = 2) -> None:
    v = current_version(spark, root) or 0
    for k in range(1, v - keep + 1):
        for name in (f"published{k}", f"v{k}", f"claim{k}"):
            p, fs, _ = _fs(spark, f"{root}/{name}")
            fs.delete(p, True)


def write_report(df: DataFrame, path: str, sep: str = ",") -> None:
    """Rows as text files with a header: id maps and revert logs (with a tab), reports. Every column is written as text."""
    df.select(*[F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite").option("header", True).option("sep", sep).csv(path)


def read_report(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    return spark.read.option("header", True).option("sep", sep).csv(path)
