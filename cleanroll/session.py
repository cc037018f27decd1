"""Session settings and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def build_session(app: str = "cleanroll", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the dataflows rely on.

    Shuffle partition counts are left to the cluster: adaptive execution coalesces
    small ones and splits skewed ones.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for staged tables: `spark.checkpoint.dir` of the session.

    Only a session of one JVM (`local`, `local[n]`) may fall back to a temporary folder; on a cluster a
    machine-local folder would be lost with its executor.
    """
    folder = spark.conf.get(CHECKPOINT_CONF, None)
    if folder:
        return folder.rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError(f"set {CHECKPOINT_CONF} to a shared folder")
    folder = tempfile.mkdtemp(prefix="cleanroll-")
    spark.conf.set(CHECKPOINT_CONF, folder)
    return folder


def stage_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def write_stage(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stage(df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
    """Write `df` once to the shared folder and return a scan of it.

    Used where several outputs are read off one expensive result: each reader
    prunes to its own columns and a lost executor does not repeat the work. It is written with zstd: staged texts
    take the most room in the shared folder.
    """
    return write_stage(df, stage_path(df.sparkSession, name), partition_by)


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of the file system that its path names; a missing one is left as it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


class Stages:
    """Staged tables with an owner: `with Stages(spark) as stages` deletes them all on leaving, also after an error.

    A result that is read later must not hang on them: write it with `stage`, or keep it out of this owner. `drop`
    deletes tables that no later step reads, so that rounds do not pile up.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self._paths: dict[int, tuple[DataFrame, str]] = {}

    def write(self, df: DataFrame, name: str, partition_by: tuple[str, ...] = ()) -> DataFrame:
        path = stage_path(self.spark, name)
        try:
            staged = write_stage(df, path, partition_by)
        except BaseException:
            delete_path(self.spark, path)
            raise
        self._paths[id(staged)] = (staged, path)
        return staged

    def drop(self, *staged: DataFrame) -> None:
        for df in staged:
            _, path = self._paths.pop(id(df))
            delete_path(self.spark, path)

    def drop_all(self) -> None:
        self.drop(*[df for df, _ in self._paths.values()])

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *error) -> None:
        self.drop_all()
