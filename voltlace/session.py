"""Session helpers shared by all operators."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
import weakref

from pyspark.sql import DataFrame, SparkSession

_own_root: dict[str, str] = {}
_cleaned: set[str] = set()
_written: dict[int, tuple[weakref.ref, str]] = {}


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for cut lineage.

    Reads ``spark.checkpoint.dir`` from the session (a folder that all
    executors share). Only where it is unset - single-process tests - a
    temporary folder is made.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own_root:
        made = tempfile.mkdtemp(prefix="voltlace-ckpt-")
        atexit.register(shutil.rmtree, made, ignore_errors=True)
        _own_root[app] = f"file://{made}"
    return _own_root[app]


def _folder(spark: SparkSession) -> str:
    """The application's part of the checkpoint folder; it is deleted when the driver's Python ends."""
    path = f"{checkpoint_root(spark)}/voltlace/{spark.sparkContext.applicationId}"
    if path not in _cleaned:
        _cleaned.add(path)
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(spark._jsc.hadoopConfiguration())

        def clean() -> None:
            try:
                fs.delete(p, True)
            except Exception:  # noqa: BLE001 - the JVM may be gone already
                pass

        atexit.register(clean)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back.

    A written table survives the loss of executors and, unlike a persisted
    one, is never recomputed; later plans start from its file statistics.
    """
    path = f"{_folder(df.sparkSession)}/{uuid.uuid4().hex}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    _written[id(out)] = (weakref.ref(out), path)
    return out


def scratch(spark: SparkSession) -> str:
    """Path of a table of one's own in the shared folder; it goes with the application's other tables."""
    return f"{_folder(spark)}/{uuid.uuid4().hex}"


def release(df: DataFrame) -> None:
    """Deletes the table that :func:`cut` wrote for ``df``, once nothing reads it any more; other tables stay."""
    ref, path = _written.pop(id(df), (lambda: None, ""))
    if ref() is df:
        p = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
