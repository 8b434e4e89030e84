"""Tables in the folder that driver and executors share; they cut the lineage of loops."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: list[str] = []
_cleaned: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The checkpoint folder of the session, or spark.checkpoint.dir. Where neither is set a local master gets a temporary folder; a cluster must name one, as executors would each write to their own disk."""
    sc = spark.sparkContext
    folder = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _local:
            _local.append("file://" + tempfile.mkdtemp(prefix="loomgraph-"))
        folder = _local[0]
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(folder)
    return folder


def own_folder(spark: SparkSession) -> str:
    """This application's part of the shared folder; it goes when Python ends, if the session still runs then."""
    sc = spark.sparkContext
    folder = f"{shared_dir(spark).rstrip('/')}/loomgraph-{sc.applicationId}"
    if folder not in _cleaned:
        _cleaned.add(folder)

        def clean() -> None:
            if sc._jsc is not None:
                path = sc._jvm.org.apache.hadoop.fs.Path(folder)
                path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)

        atexit.register(clean)
    return folder


def stage_table(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write a Parquet table in the shared folder and read it back.

    It cuts the lineage and outlives lost executors like a reliable checkpoint, but is
    compressed and can be read by columns, and its size is that of its files. A
    checkpoint hands on the size estimate of its plan instead; in loops with joins the
    estimates multiply until they are numbers of millions of digits.
    """
    path = f"{own_folder(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._stage_path = path
    return table


def drop_tables(*tables: DataFrame | None) -> None:
    """Remove tables of stage_table that nothing reads any more, so that loops don't fill the shared folder. Other frames are left alone."""
    for table in tables:
        name = getattr(table, "_stage_path", None)
        if name is not None:
            spark = table.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
