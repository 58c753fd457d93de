"""Session settings and the shared folder for data that must outlive an executor."""

import contextlib
import re
import tempfile
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def build_session(app_name="barworks", master=None, **conf):
    """A session with the settings the library is designed around.

    On a cluster, leave ``master`` out and pass sizes (for example
    ``spark.sql.shuffle.partitions``) through ``conf``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


@contextlib.contextmanager
def settings(spark, values):
    """Session settings for the plans that are built and run inside; put back afterwards."""
    before = {key: spark.conf.get(key, None) for key in values}
    try:
        for key, value in values.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


# Written tables are packed by zstd: about a quarter smaller than Spark's default, for scratch tables as for layers.
PACKED = {"compression": "zstd"}


def tidy(spark):
    """Shuffle files of a job go when the job ends.

    By default they stay until the driver's heap happens to be collected, so a run of several jobs holds
    the shuffles of all of them at once. A frame that is run again makes its shuffles again.
    """
    return settings(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def shared_dir(spark):
    """The folder named by spark.checkpoint.dir, which every executor can reach.

    Only where it is unset and the session runs in one process (tests) is a
    temporary folder made; on a cluster each executor would write to its own disk.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current is None:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="barworks-"))
        current = spark.sparkContext.getCheckpointDir()
    return current.rstrip("/")


def scratch_path(spark, name):
    """A fresh path under the shared folder."""
    return f"{shared_dir(spark)}/barworks/{name}-{uuid.uuid4().hex}"


def _path_and_fs(spark, path):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return jvm_path, fs


def path_exists(spark, path):
    jvm_path, fs = _path_and_fs(spark, path)
    return fs.exists(jvm_path)


def delete_path(spark, path):
    jvm_path, fs = _path_and_fs(spark, path)
    return fs.delete(jvm_path, True)


def qualified_path(spark, path):
    """The path with its scheme, the same however it was spelled."""
    jvm_path, fs = _path_and_fs(spark, path.rstrip("/"))
    return fs.makeQualified(jvm_path).toString()


def any_file(spark, pattern):
    """Whether a file matches a glob pattern."""
    jvm_path, fs = _path_and_fs(spark, pattern)
    return len(fs.globStatus(jvm_path) or []) > 0


def files_in(spark, path):
    """Paths of the files that lie directly in a folder."""
    jvm_path, fs = _path_and_fs(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(jvm_path) if f.isFile()]


def folders_in(spark, path):
    """Paths of the folders that lie directly in a folder."""
    jvm_path, fs = _path_and_fs(spark, path)
    return [f.getPath().toString() for f in fs.listStatus(jvm_path) if f.isDirectory()]


def replace_path(spark, source, target):
    """Move a file or folder in place of another, on the same file system."""
    jvm_target, fs = _path_and_fs(spark, target)
    fs.mkdirs(jvm_target.getParent())
    fs.delete(jvm_target, True)
    if not fs.rename(_path_and_fs(spark, source)[0], jvm_target):
        raise OSError(f"could not move {source} to {target}")


def touch_path(spark, path):
    jvm_path, fs = _path_and_fs(spark, path)
    fs.create(jvm_path, True).close()


def no_rows(spark, schema):
    """An empty frame that costs no Python task, as one made from a list would."""
    return spark.range(0).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema])


def write_and_reread(df, path, partition_by=None):
    """Cut the lineage through a written table rather than through memory.

    The files survive the loss of any executor, and every later action reads
    columns from parquet instead of running the upstream plan again.
    """
    writer = df.write.mode("overwrite").options(**PACKED)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with tidy(df.sparkSession):
        writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
