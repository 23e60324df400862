"""Session helpers: settings, lineage cuts and small driver-side bounds."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import DataFrame, SparkSession

SESSION_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g", stages: str | None = None) -> SparkSession:
    """Session for tests and the local benchmark, with a folder for stage tables; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tissuegrid")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
    )
    for key, value in SESSION_SETTINGS.items():
        builder = builder.config(key, value)
    if stages:
        builder = builder.config("spark.checkpoint.dir", stages)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for stage tables: the one in ``spark.checkpoint.dir``, or one beside the session's warehouse if that is unset.

    A warehouse on a machine's own disk serves local sessions only: on a cluster each executor would write its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/stages"
        if is_cluster(sc.master) and folder.split(":", 1)[0] in ("file", folder):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def is_cluster(master: str) -> bool:
    return master != "local" and not master.startswith("local[")


_STAGES: dict[str, SparkSession] = {}


def stage_folder(spark: SparkSession) -> str:
    """This run's own folder for stage tables; it goes when the session's Python process ends."""
    base = ensure_checkpoint_dir(spark)
    for path, session in _STAGES.items():
        if path.startswith(f"{base}/") and session.sparkContext is spark.sparkContext:
            return path
    path = f"{base}/run-{uuid.uuid4().hex}"
    if not _STAGES:
        atexit.register(drop_stages)
    _STAGES[path] = spark
    return path


def drop_stages() -> None:
    """Delete the stage tables of this run. Tables read from them can't be read any more."""
    while _STAGES:
        path, spark = _STAGES.popitem()
        if spark.sparkContext._jsc is not None:  # the session still stands
            jvm = spark.sparkContext._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows as a stage table in the shared folder and go on from there.

    A lost executor then rereads files instead of replaying earlier rounds, the next plan starts small
    and knows the real size of its input.
    """
    spark = df.sparkSession
    path = f"{stage_folder(spark)}/stage-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    return spark.read.schema(schema).parquet(path)


def fanout(spark: SparkSession) -> int:
    """How many pieces the rows are cut into: four per shuffle partition to even out."""
    return max(2, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
