"""Tables written once in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Folders of sessions in local mode that name none.
_LOCAL: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The shared folder of the cluster; a local one only in local mode, where the session names none."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        key = spark.sparkContext.applicationId
        if key not in _LOCAL:
            _LOCAL[key] = tempfile.mkdtemp(prefix="readkin-")
        root = _LOCAL[key]
    return root.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder."""
    return f"{shared_folder(spark)}/readkin/{name}-{uuid.uuid4().hex[:12]}"


def scratch(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage with files that outlive any executor.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(table: DataFrame | None) -> None:
    """Delete the files of a table that ``scratch`` returned, when nothing reads it any more; any other table stays."""
    path = getattr(table, "scratch_path", None)
    if path:
        jvm = table.sparkSession._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(table.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
