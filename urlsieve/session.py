"""Session helpers: where checkpoints and intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_local_dirs: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting falls back to a temporary folder of this machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="urlsieve-")
    return _local_dirs[app]


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Let ``checkpoint()`` and the iterative MLlib trainers cut lineage in the shared folder."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage reliably (survives the loss of executors)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, column-pruned, no lineage to replay."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage_measured(df: DataFrame, name: str, text: str) -> tuple[DataFrame, int, int]:
    """``stage_table``, with its rows and the bytes of one text column, counted from what was written.

    Not counted with an ``Observation`` during the write: a session that has used one can no longer be
    serialised, and fitted MLlib models carry their session.
    """
    table = stage_table(df, name)
    row = table.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    return table, row[0], row[1]
