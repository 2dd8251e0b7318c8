"""Session helpers: builder with engine defaults, table loading, and reliable lineage cuts."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_fallback: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "rolemill", master: str | None = None, **conf: object) -> SparkSession:
    """A session with the engine's defaults; every default can be overridden through ``conf``."""
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**defaults, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(k, str(v))
    return builder.getOrCreate()


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """Scan one table of a data directory; columns and filters are pruned by Catalyst."""
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: spark.checkpoint.dir. Where that is unset, a local one, in local mode alone:
    on a cluster every executor would write to a disk of its own."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    app, master = spark.sparkContext.applicationId, spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    if app not in _fallback:
        _fallback[app] = "file://" + tempfile.mkdtemp(prefix="rolemill-")
    return _fallback[app]


def materialize(df: DataFrame, name: str = "cut") -> DataFrame:
    """Cut the lineage with a table written to the shared folder.

    Parquet rather than a checkpoint: columns read later are pruned and the files are compressed. It survives the
    loss of any executor.
    """
    path = f"{shared_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._rolemill_path = path
    return out


def release(df: DataFrame) -> None:
    """Delete the files of a materialized table that no later step reads."""
    path = getattr(df, "_rolemill_path", None)
    if path:
        spark = df.sparkSession
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def ship_code(spark: SparkSession) -> None:
    """Send this package to the Python workers, unless they find it by PYTHONPATH or the working folder."""
    import zipfile
    from pathlib import Path

    package = Path(__file__).resolve().parent
    known = [p for p in os.environ.get("PYTHONPATH", "").split(os.pathsep) if p] + [os.getcwd()]
    app = spark.sparkContext.applicationId
    if app in _shipped or any(Path(p).resolve() == package.parent for p in known):
        return
    _shipped.add(app)
    target = Path(tempfile.mkdtemp(prefix="rolemill-code-")) / "rolemill.zip"
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    spark.sparkContext.addPyFile(str(target))


def env_cpus(default: int = 8) -> int:
    return int(os.environ.get("BENCH_CPUS", default))
