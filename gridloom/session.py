"""Session-level helpers."""

import tempfile


def shared_dir(spark):
    """Folder that every executor can reach, taken from spark.checkpoint.dir.

    Only a local master may go without it; it then gets a fresh temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="gridloom-"))
    return spark.sparkContext.getCheckpointDir()


def barrier_slots(spark):
    """How many tasks a barrier stage may have just now: all of them run at once. None with dynamic allocation, where Spark refuses such stages."""
    if spark.sparkContext.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    context = spark.sparkContext._jsc.sc()
    return context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile())


def locate(path):
    """pyarrow file system and inner path of whatever the path names."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))
    return fs.LocalFileSystem(), path.removeprefix("file:")


def _file_system(spark, path):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def is_written(spark, folder):
    """Whether a write job has finished in the folder."""
    system, path = _file_system(spark, f"{folder}/_SUCCESS")
    return system.exists(path)


def remove(spark, pattern):
    """Delete the folders that a path pattern names; none is fine."""
    system, path = _file_system(spark, pattern)
    for found in system.globStatus(path) or []:
        system.delete(found.getPath(), True)
