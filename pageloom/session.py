"""Session settings the jobs are written for. A cluster's own settings win."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that a table may take in memory to be sent to all tasks by ``light``, and those of a row beside its texts.
SENT, ROW = 128 << 20, 64

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, memory: str = "12g") -> SparkSession:
    """A local session for tests and the bench."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("pageloom")
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.config("spark.driver.memory", memory).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prefer(spark: SparkSession, key: str, value: str) -> None:
    """A setting of this session, unless it has been given one."""
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, value)


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only a local master may go without one; it then gets a folder of its own, removed at exit. On a
    cluster a missing setting is an error, since a local folder there differs from machine to machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    master = spark.conf.get("spark.master", "local")
    if master != "local" and not master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    folder = tempfile.mkdtemp(prefix="pageloom-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def _forget(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table when the process ends, through Spark's own view of the file system."""
    if urlparse(path).scheme in ("", "file"):
        shutil.rmtree(urlparse(path).path, ignore_errors=True)
        return
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # noqa: BLE001  the session has ended already; the folder's owner clears it
        pass


def shared_path(spark: SparkSession, tag: str) -> str:
    """A new path in the shared folder, removed when the process ends."""
    path = f"{shared_dir(spark)}/pageloom-{tag}-{uuid.uuid4().hex}"
    atexit.register(_forget, spark, path)
    return path


def release(spark: SparkSession) -> None:
    """Let Spark remove the shuffle files of finished steps. It does so when the driver's garbage collector has found that
    nothing refers to them, which by itself may take until a job has filled the disk."""
    spark.sparkContext._jvm.System.gc()


def written(df: DataFrame, tag: str = "table", by: str = "") -> DataFrame:
    """A table that several later steps read: written once to the shared folder and read back, so the
    steps neither recompute it nor depend on any executor keeping it. What was shuffled to make it goes. ``by`` names
    the column of a table that is to be ``dealt``."""
    if by:
        return dealt(df, by, tag)
    spark = df.sparkSession
    path = shared_path(spark, tag)
    df.write.parquet(path)
    release(spark)
    return spark.read.schema(df.schema).parquet(path)


def dealt(df: DataFrame, key: str, tag: str = "dealt") -> DataFrame:
    """As ``written``, and dealt by the values of a column: windows, groups and joins over it, and over it with more columns,
    read the table without moving its rows again. There are as many buckets as the session's shuffles have partitions.

    Only a table of the session's catalog knows its buckets; its name goes at once, the files stay until the process ends."""
    spark = df.sparkSession
    path, name = shared_path(spark, tag), f"pageloom_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartition(buckets, key).write.format("parquet").option("path", path).option("compression", "zstd")
    rows.bucketBy(buckets, key).saveAsTable(name)
    out = spark.table(name)
    spark.sql(f"DROP TABLE {name}")
    release(spark)
    return out


def light(df: DataFrame) -> DataFrame:
    """A written table, marked to be sent to all tasks of a join if it takes at most ``SENT`` bytes there: its rows are counted
    and its texts measured, whatever size Spark would allow without a look at them."""
    texts = [F.coalesce(F.sum(F.length(f.name)), F.lit(0)) for f in df.schema.fields if f.dataType.typeName() == "string"]
    rows, *sizes = df.agg(F.count(F.lit(1)), *texts).first()
    return F.broadcast(df) if rows * ROW + sum(sizes) <= SENT else df


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Give heavy per-row work one partition per core when the scan has fewer splits than cores.

    A large input already has more splits than cores and passes through without a shuffle."""
    wanted = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= wanted:
        return df
    return df.repartition(wanted, *keys)
