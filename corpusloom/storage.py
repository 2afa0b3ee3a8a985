"""The folder that executors share, cutting lineage in it, and small files on any file system that Spark knows."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session; where it is unset (local runs), a new temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("on a cluster spark.checkpoint.dir must name a shared folder")
        named = "file://" + tempfile.mkdtemp(prefix="corpusloom-core-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(named)
    return named


def checkpointed(df: DataFrame) -> DataFrame:
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def spread(scan: DataFrame) -> DataFrame:
    """A plain scan, shuffled over all cores if it comes in fewer pieces than there are cores.

    For work that costs far more than moving its input. A scan of many files, as of any large table, stays as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    pieces = scan._jdf.queryExecution().toRdd().getNumPartitions()
    return scan.repartition(cores) if pieces < cores else scan


def task_count(spark: SparkSession) -> int:
    """The number of tasks for work that isn't in proportion to bytes: a few for each core, more where the session has more partitions."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def evenly(rows: DataFrame) -> DataFrame:
    """Short rows that each stand for work, such as a file, in partitions of equal numbers that aren't merged by size."""
    return rows.repartition(task_count(rows.sparkSession))


def hadoop(uri: str, scheme: str = "file://"):
    """The JVM's gateway, the file system of a path and the path in it; ``scheme`` goes before a path without one."""
    spark = SparkSession.active()
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri if "://" in uri or uri.startswith("file:") else f"{scheme}{uri}")
    return jvm, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def exists(uri: str) -> bool:
    _, fs, path = hadoop(uri)
    return fs.exists(path)


def write_bytes(uri: str, data: bytes) -> None:
    """A small file, whole or not at all: it is written under another name and moved over the one that may be there."""
    jvm, fs, path = hadoop(uri)
    draft = jvm.org.apache.hadoop.fs.Path(path.getParent(), f".{path.getName()}.{uuid.uuid4().hex}")
    out = fs.create(draft, True)
    out.write(bytearray(data))
    out.close()
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = SparkSession.active().sparkContext._gateway.new_array(rename, 1)
    how[0] = rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(path.toUri(), fs.getConf()).rename(fs.makeQualified(draft), fs.makeQualified(path), how)


def join_files(folder: str, target: str, head: bytes, tail: bytes, skip: int) -> None:
    """The files that tasks wrote into a folder, by name and one after the other, between ``head`` and ``tail``; of the first that isn't empty without ``skip`` bytes."""
    jvm, fs, path = hadoop(folder, "")
    parts = sorted((s.getPath().getName(), s.getLen()) for s in fs.listStatus(path) if s.getPath().getName().startswith("part-") and s.getLen())
    out = fs.create(jvm.org.apache.hadoop.fs.Path(target), True)
    out.write(bytearray(head))
    for k, (name, _) in enumerate(parts):
        source = fs.open(jvm.org.apache.hadoop.fs.Path(path, name))
        source.seek(0 if k else skip)
        jvm.org.apache.hadoop.io.IOUtils.copyBytes(source, out, 1 << 20, False)
        source.close()
    out.write(bytearray(tail))
    out.close()


def move_file(source: str, target: str) -> None:
    jvm, fs, path = hadoop(target, "")
    fs.delete(path, True)
    if not fs.rename(jvm.org.apache.hadoop.fs.Path(source), path):
        raise OSError(f"{source} can't be moved to {target}")


def remove_folder(uri: str) -> None:
    _, fs, path = hadoop(uri, "")
    fs.delete(path, True)


def move_folder(source: str, target: str) -> None:
    """A written folder in place of what may be at ``target``, marked as whole; if there is no such folder, an empty one."""
    jvm, fs, path = hadoop(target, "")
    fs.delete(path, True)
    fs.mkdirs(path.getParent())
    start = jvm.org.apache.hadoop.fs.Path(source)
    if not (fs.rename(start, path) if fs.exists(start) else fs.mkdirs(path)):
        raise OSError(f"{source} can't be moved to {target}")
    fs.create(jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"), True).close()


def read_bytes(uri: str) -> bytes:
    jvm, fs, path = hadoop(uri)
    source = fs.open(path)
    try:
        return bytes(jvm.org.apache.commons.io.IOUtils.toByteArray(source))
    finally:
        source.close()
