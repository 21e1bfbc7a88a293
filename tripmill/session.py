"""Session settings and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """Session for tests and benchmarks; a cluster brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripmill")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def ensure_utc(spark: SparkSession) -> SparkSession:
    """Hour flooring of zone-less timestamps is only exact where no hour is skipped or repeated."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; a temporary one only on a local master."""
    configured = spark.conf.get(CHECKPOINT_SETTING, None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError(f"{CHECKPOINT_SETTING} must name a folder that all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = tempfile.mkdtemp(prefix="tripmill-")
    return _local_folders[app]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder through the file system that it lies in; one that is missing is no error."""
    jvm = spark.sparkContext._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


@dataclass
class Stage:
    """Written intermediate results.

    A staged frame is read back from shared storage, so a lost executor costs a re-read instead of a
    recomputation of the whole lineage, and Catalyst knows its size.
    """

    spark: SparkSession
    root: str = field(default="")

    def __post_init__(self) -> None:
        if not self.root:
            self.root = f"{shared_folder(self.spark)}/stage-{uuid.uuid4().hex}"

    def __enter__(self) -> "Stage":
        return self

    def __exit__(self, *failure: object) -> None:
        self.close()

    def close(self) -> None:
        """Remove all that was staged. Frames read from here cannot be used afterwards."""
        remove(self.spark, self.root)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}-{uuid.uuid4().hex[:12]}"

    def save(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
