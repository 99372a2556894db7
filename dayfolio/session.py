"""Session defaults and the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(cpus: int | str = "*", name: str = "dayfolio", **conf: str) -> SparkSession:
    """A local session with the settings the jobs are tested with.

    On a cluster, use the session the cluster gives you instead.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


#: Bytes that a Python worker gets at a time; it holds several copies of them.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession, most: int = BATCH_BYTES) -> None:
    """Bounds the batches that go to Python by their bytes, as 10,000 long texts are too many for a worker.

    A longer text still goes whole, as a batch of its own.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a local session without the setting gets a folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="dayfolio-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared folder and continue from there.

    The copy outlives executors, unlike a local checkpoint or a cache. With
    ``spark.cleaner.referenceTracking.cleanCheckpoints`` it goes when nothing
    refers to it any more.
    """
    spark = df.sparkSession
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        context.setCheckpointDir(shared_folder(spark))
    return df.checkpoint(eager=True)


#: Compressed bytes that a task collects before it writes them.
ROW_GROUP_BYTES = 16 << 20


def write_columns(df: DataFrame) -> DataFrame:
    """The same as ``cut_lineage`` for many or long rows: they are written as compressed columns.

    A checkpoint takes several times the disk, and all of a row is read whatever
    is asked of it. The files go when the driver ends. Rows that hold lists are
    read one by one, as a batch of thousands of documents is too many for a task.
    """
    spark = df.sparkSession
    spark.conf.set("spark.sql.parquet.enableNestedColumnVectorizedReader", "false")
    folder = f"{shared_folder(spark).rstrip('/')}/columns-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    df.write.options(**{"compression": "zstd", "parquet.block.size": str(ROW_GROUP_BYTES), "parquet.block.size.row.check.min": "1"}).parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)
