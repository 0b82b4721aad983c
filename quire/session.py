"""Session helpers: tables, scratch storage shared by all executors, bounded broadcasts."""

from __future__ import annotations

import atexit
import contextlib
import os
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_ROOTS: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table as it lies in ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables.

    ``spark.checkpoint.dir`` is read from the session, as it names a folder that every executor
    shares. Only where it is unset (tests, local runs) a temporary folder is made.
    """
    key = spark.sparkContext.applicationId
    if key not in _ROOTS:
        base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
        if not base:
            if not spark.sparkContext.master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
            base = tempfile.mkdtemp(prefix="quire-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
        _ROOTS[key] = f"{base.rstrip('/')}/quire-{uuid.uuid4().hex[:12]}"
        atexit.register(_drop, spark, _ROOTS[key])
    return _ROOTS[key]


def _drop(spark: SparkSession, root: str) -> None:
    """Delete this session's intermediate tables when the driver ends in order."""
    with contextlib.suppress(Exception):
        sc = spark.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def cut(df: DataFrame, name: str = "t") -> DataFrame:
    """Write ``df`` to scratch storage and read it back.

    This ends the lineage with a table that survives the loss of any executor, and gives the
    planner true sizes for what follows.
    """
    path = f"{scratch_root(df.sparkSession)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession, least: int = 1) -> int:
    """Shuffle partitions of this session, at least ``least``."""
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def single_thread() -> None:
    """Keep native libraries of a Python worker on one core; the executor runs one task a core."""
    for name in ("OMP_NUM_THREADS", "OPENBLAS_NUM_THREADS", "RAYON_NUM_THREADS"):
        os.environ[name] = "1"
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
