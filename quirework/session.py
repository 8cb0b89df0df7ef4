"""Session helpers shared by every operator."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Setting that names the folder every executor shares.
CHECKPOINT_CONF = "spark.checkpoint.dir"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Folder for cut lineage: the one the session names, else (local masters only) a temporary one."""
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder all executors share")
        named = tempfile.mkdtemp(prefix="quirework-checkpoint-")
    sc.setCheckpointDir(named)
    return named


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder, so that it is computed once and survives lost executors."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


_scratch: dict[str, list[str]] = {}


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared one for what is needed until the application ends; it is removed then."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/quirework-{name}-{uuid.uuid4().hex}"
    if not _scratch:
        atexit.register(_release_all)
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def release_scratch(spark: SparkSession) -> int:
    """Remove the scratch folders of this application; how many there were. Frames that read them can't be used after."""
    context = spark.sparkContext
    folders = _scratch.pop(context.applicationId, [])
    for folder in folders:
        place = context._jvm.org.apache.hadoop.fs.Path(folder)
        place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)
    return len(folders)


def _release_all() -> None:
    try:
        spark = SparkSession.getActiveSession()
        if spark is not None:
            release_scratch(spark)
    except Exception:  # noqa: BLE001, S110 - the application is gone, and so is the right to its folders
        pass


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to and read from a scratch folder."""
    folder = scratch_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
