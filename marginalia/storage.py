"""Tables that a job writes for itself in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_made: list[tuple[SparkSession, str]] = []
_tables: list[tuple[SparkSession, str]] = []
_ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors where their Python path does not hold it."""
    here = [os.path.abspath(x or ".") for x in os.environ.get("PYTHONPATH", "").split(":")]
    if _ROOT in here or getattr(spark, "_marginalia_shipped", False):
        return
    folder = tempfile.mkdtemp(prefix="marginalia-zip-")
    spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/marginalia", "zip", _ROOT, "marginalia"))
    spark._marginalia_shipped = True


def drop_at_end(spark: SparkSession, table: str) -> None:
    """Takes a table out of the session's catalogue when this process ends; its files go with the scratch tables."""
    _tables.append((spark, table))


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset, as in tests on one machine, a temporary folder."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="marginalia-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    if not _made:
        atexit.register(release)
    path = f"{shared_dir(spark)}/marginalia/{uuid.uuid4().hex}/{name}"
    _made.append((spark, path))
    return path


def release() -> None:
    """Deletes the scratch tables of this process; data frames that read them end with it."""
    while _tables:
        spark, table = _tables.pop()
        try:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
        except Exception:  # noqa: BLE001 - the session has ended, and its catalogue with it
            continue
    while _made:
        spark, path = _made.pop()
        try:
            p = spark._jvm.org.apache.hadoop.fs.Path(path).getParent()
            p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
        except Exception:  # noqa: BLE001 - the session has ended; nothing is left to delete with
            return


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Writes ``df`` once and reads it again: what follows starts from files that survive lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
