"""Session settings, and the shared folder that cuts lineage."""

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = Path(__file__).resolve().parent.parent
_local_dirs: dict[str, str] = {}
_written: list[str] = []
_shipped: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "larder") -> SparkSession:
    """A local session with the settings tests and the bench use."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship(spark: SparkSession) -> None:
    """Send the package to the workers, unless they find it by PYTHONPATH or lie in its folder."""
    sc = spark.sparkContext
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), os.getcwd()]
    if sc.applicationId in _shipped or str(ROOT) in known:
        return
    archive = f"{tempfile.mkdtemp(prefix='larder-package-')}/larder.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for path in sorted((ROOT / "larder").rglob("*.py")):
            z.write(path, path.relative_to(ROOT))
    sc.addPyFile(archive)
    _shipped.add(sc.applicationId)


SMALL_BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "1000"), "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "16m")}


def small_batches(spark: SparkSession) -> None:
    """Arrow batches for rows that hold long texts: a tenth of Spark's rows, a quarter of its bytes; a size that is set already stays."""
    for key, (default, small) in SMALL_BATCHES.items():
        if spark.conf.get(key, default) == default:
            spark.conf.set(key, small)


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir, or the context's checkpoint folder.

    Only a local master, whose executors share the driver's disk, may go without; it gets a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if named:
        return named
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if sc.applicationId not in _local_dirs:
        _local_dirs[sc.applicationId] = tempfile.mkdtemp(prefix="larder-")
        _written.append(_local_dirs[sc.applicationId])
    return _local_dirs[sc.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, folders: tuple[str, ...] = ()) -> DataFrame:
    """Write once to the shared folder and read from there, so that lineage ends and an executor loss costs a re-read.

    With `folders`, rows lie in a folder for each value of those columns. The table is deleted when the driver ends.
    """
    path = scratch_path(df.sparkSession, "table")
    _written.append(path)
    df.write.partitionBy(*folders).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_paths(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for p in paths:
        path = jvm.org.apache.hadoop.fs.Path(p)
        path.getFileSystem(conf).delete(path, True)


@atexit.register
def release_tables() -> None:
    """Delete what materialize() has written; called when the driver ends."""
    spark = SparkSession.getActiveSession()
    if spark is not None and _written:
        delete_paths(spark, _written)
        _written.clear()


class Scratch:
    """Written tables that live for one step of a loop."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def keep(self, df: DataFrame) -> DataFrame:
        path = scratch_path(self.spark, "step")
        self.paths.append(path)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def release(self) -> None:
        delete_paths(self.spark, self.paths)
        self.paths = []
