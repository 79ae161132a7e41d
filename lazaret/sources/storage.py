"""Paths: the shared work folder, and folders that appear whole."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession

# Schemes of stores that copy a folder file by file when it is renamed.
OBJECT_STORES = {"s3", "s3a", "s3n", "gs", "oss", "obs", "cos", "cosn", "swift", "wasb", "wasbs"}

_local_root: str | None = None


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it in ``spark.checkpoint.dir``.

    Only a session in local mode may go without; it gets a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    global _local_root
    if _local_root is None:
        _local_root = tempfile.mkdtemp(prefix="lazaret-")
        atexit.register(shutil.rmtree, _local_root, ignore_errors=True)
    return _local_root


def work_folder(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared root; nothing is created."""
    return f"{shared_root(spark)}/lazaret/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _scheme(fs) -> str:
    return fs.getUri().getScheme()


def full_path(spark: SparkSession, path: str) -> str:
    """The path with its scheme, as listings give it."""
    fs, target = _file_system(spark, path)
    return fs.makeQualified(target).toString()


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def has_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a path fits a glob pattern."""
    fs, target = _file_system(spark, pattern)
    return bool(fs.globStatus(target))


def make_folder(spark: SparkSession, path: str) -> None:
    """Create a folder, so that a stream can be started on a topic nobody has written to yet."""
    fs, target = _file_system(spark, path)
    fs.mkdirs(target)


def is_pattern(path: str) -> bool:
    return any(c in path for c in "*?[{")


def hidden_beside(path: str) -> str:
    """A new folder name next to ``path`` that readers of the parent do not see."""
    return f"{path.rsplit('/', 1)[0]}/_staging/{uuid.uuid4().hex}"


def reveal(spark: SparkSession, hidden: str, path: str) -> bool:
    """Rename a finished folder to the name readers look for; False if that name is taken.

    The rename is one step in HDFS and on local disks. Stores without one are refused; ``commits.CommitLog`` serves there.
    """
    fs, source = _file_system(spark, hidden)
    if _scheme(fs) in OBJECT_STORES:
        raise ValueError(f"{_scheme(fs)} does not rename a folder in one step: use a commit log there (LogHub)")
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    if fs.exists(target):
        return False
    if not fs.rename(source, target):
        raise OSError(f"{hidden} could not be renamed to {path}")
    return True


def write_whole(spark: SparkSession, path: str, write: Callable[[str], None]) -> bool:
    """Let ``write`` fill a hidden folder and reveal it as ``path``; False if that is there already.

    So a folder that can be seen is complete, and one whose job broke off is never read.
    """
    if exists(spark, path):
        return False
    hidden = hidden_beside(path)
    write(hidden)
    return reveal(spark, hidden, path)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if it is not there."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        return []
    return [s.getPath().getName() for s in fs.listStatus(target)]


def files_below(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """Full paths and sizes of all files below a folder."""
    fs, target = _file_system(spark, path)
    found, listed = [], fs.listFiles(target, True)
    while listed.hasNext():
        status = listed.next()
        found.append((status.getPath().toString(), status.getLen()))
    return found


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder that the engine wrote itself."""
    fs, target = _file_system(spark, path)
    fs.delete(target, True)


def get_text(spark: SparkSession, path: str) -> str:
    """A small file's text; FileNotFoundError if it is not there."""
    fs, target = _file_system(spark, path)
    if not fs.exists(target):
        raise FileNotFoundError(path)
    stream = fs.open(target)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that appears whole; FileExistsError if its name is taken.

    Object stores show a file when it is closed; elsewhere it is written under a hidden name and renamed.
    """
    fs, target = _file_system(spark, path)
    if fs.exists(target):
        raise FileExistsError(path)
    direct = _scheme(fs) in OBJECT_STORES
    hidden = target if direct else spark._jvm.org.apache.hadoop.fs.Path(f"{path.rsplit('/', 1)[0]}/_{uuid.uuid4().hex}")
    stream = fs.create(hidden, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not direct and (fs.exists(target) or not fs.rename(hidden, target)):
        raise FileExistsError(path)
