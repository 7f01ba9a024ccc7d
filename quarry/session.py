"""Session defaults, table access and scratch storage that survives executor loss."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings a fresh session gets; a session that already runs keeps its own.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str = "local[8]", app: str = "quarry", **conf: str) -> SparkSession:
    """Start, or get, a session with Quarry's defaults."""
    builder = SparkSession.builder.master(master).appName(app)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


#: A table of fewer files than cores and of a size between these is spread before use.
SPREAD_BYTES, SPREAD_MOST = 2_000_000, 256_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data directory, read lazily (the scan prunes columns and filters).

    A small file is often one row group, which one task reads and then works on alone. So a
    table of at most ``SPREAD_MOST`` bytes in fewer files than cores is dealt out anew.
    Beyond that size no table is: its row groups are its splits.
    """
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if not SPREAD_BYTES < size <= SPREAD_MOST:
        return df
    cores = spark.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session that names none (tests) gets a local folder; elsewhere each machine
    would write to its own disk, so that is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    made = f"file://{tempfile.mkdtemp(prefix='quarry-shared-')}"
    spark.sparkContext.setCheckpointDir(made)
    return shared_dir(spark)


#: Folders that ``materialise`` has made in this process, oldest first.
_MADE: list[str] = []


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` into the shared folder and read it back.

    Cuts the lineage: what follows never recomputes ``df``, and a lost executor costs
    the tasks it ran, not the stages before. Each call has a folder of its own.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/quarry/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _MADE.append(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_mark() -> int:
    """What ``drop_scratch`` takes to delete only what is made from now on."""
    return len(_MADE)


def drop_scratch(spark: SparkSession, since: int = 0, keep: int = 0) -> None:
    """Delete what ``materialise`` has left since a mark, but for the last ``keep`` folders."""
    end = max(since, len(_MADE) - keep)
    for path in _MADE[since:end]:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    del _MADE[since:end]


def data_dir(default: str = "/root/testdata/sf0.1") -> str:
    return os.environ.get("BENCH_SF_DIR", default)
