"""Session defaults that every plan in this package assumes."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The codecs and the named date ranges follow the session time zone; adaptive
# execution re-plans joins and splits skewed shuffle partitions at run time.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, **conf: str) -> SparkSession:
    """A session for tests and benches; on a cluster use the session you are given."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("foldergrid")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def use_defaults(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session made elsewhere."""
    for key, value in DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under the checkpoint folder the session names (spark.checkpoint.dir).

    Without a configured folder only a session whose tasks run in the driver itself gets one
    of its own: anywhere else it would not be shared.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("Set spark.checkpoint.dir to a folder all executors share.")
        folder = tempfile.mkdtemp(prefix="foldergrid-")
        spark.conf.set("spark.checkpoint.dir", folder)  # one folder a session
    return f"{folder.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """`df` computed once, written as a table to the shared folder, and read back from there.
    For results that several later jobs read."""
    path = shared_folder(df.sparkSession, "foldergrid")
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._cut_at = path
    return table


def forget(*tables: DataFrame) -> None:
    """Remove what `cut_lineage` has written for tables that nothing reads any more."""
    for table in tables:
        remove_folder(table.sparkSession, table._cut_at)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder of intermediate files and all it holds."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def shuffle_width(spark: SparkSession) -> int:
    """Partition count for repartitions whose rows are tiny but whose work is not.

    Adaptive execution would merge such partitions by their bytes, so the count
    has to be explicit.
    """
    configured = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(configured, spark.sparkContext.defaultParallelism)
