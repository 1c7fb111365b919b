"""Tables in the shared folder, which driver and executors see."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """A new folder under spark.checkpoint.dir. Where that is unset a temporary folder serves a session on one machine; on a cluster it is an error, since executors don't share such folders."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="tapeline-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/tapeline-{uuid.uuid4().hex}"


#: Rows that a task takes where rows are dealt by a key and sorted, so that its memory doesn't grow with the table.
TASK_ROWS = 250_000


def tasks_for(df: DataFrame, rows: int = TASK_ROWS) -> int | None:
    """How many tasks take df's rows, at most about `rows` each, and no fewer than the session runs at once; nothing if one would do. A number that is given is kept: Spark
    would merge partitions by their bytes, of which sorted rows take many more in memory. The rows are counted: of Parquet, from footers."""
    need = -(-df.count() // rows)
    return max(need, df.sparkSession.sparkContext.defaultParallelism) if need > 1 else None


#: Spark's setting by which an execution's shuffle files go when it ends, not when the driver happens to collect its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """What is executed inside leaves no shuffle files: for tables that are stored, since their lineage ends there."""
    old = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if old is None else spark.conf.set(CLEANUP, old)


def materialise(df: DataFrame, place: str | None = None, codec: str | None = None) -> DataFrame:
    """Write df as Parquet in the shared folder and read it again: lineage ends there. `codec` is the files' compression, by default the session's."""
    place = place or shared_dir(df.sparkSession)
    with without_leftovers(df.sparkSession):
        (df.write.option("compression", codec) if codec else df.write).mode("overwrite").parquet(place)
    return df.sparkSession.read.schema(df.schema).parquet(place)
