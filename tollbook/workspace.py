"""Shared scratch space, folders and sessions of a run."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_CHECKPOINT_DIR = "spark.checkpoint.dir"
ZONE = "spark.sql.session.timeZone"
_own_dirs: dict[str, str] = {}
_new_paths: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors see, as the session names it in ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a temporary folder, removed at exit; a
    cluster has no folder that is safe to guess, so that is an error.
    """
    named = spark.conf.get(_CHECKPOINT_DIR, None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"set {_CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _own_dirs:
        folder = tempfile.mkdtemp(prefix="tollbook-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        _own_dirs[context.applicationId] = folder
    return _own_dirs[context.applicationId]


def new_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that nothing else uses."""
    path = f"{shared_dir(spark)}/{label}-{uuid4().hex}"
    _new_paths.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def clear_intermediates(spark: SparkSession) -> int:
    """Deletes what this application has put in the shared folder through ``new_path``; returns how many paths that were.

    Results that are not yet written read from there, so write them first. What other
    applications keep in the folder stays.
    """
    paths = [path for path in _new_paths.pop(spark.sparkContext.applicationId, []) if exists(spark, path)]
    for path in paths:
        delete(spark, path)
    return len(paths)


def scratch_path(spark: SparkSession, label: str, scratch: str | None, output: str) -> str:
    """A new path for a job's own data: below ``scratch``, the session's shared folder or the output.

    The output is seen by all executors by definition, so a job without any scratch
    setting keeps its data there, in a folder that readers of the output skip.
    """
    base = scratch or spark.conf.get(_CHECKPOINT_DIR, None) or f"{output.rstrip('/')}/_scratch"
    return f"{base.rstrip('/')}/{label}-{uuid4().hex}"


def _hadoop_path(spark: SparkSession, path: str) -> tuple[object, object]:
    java_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return java_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), java_path


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any file system; none if it does not exist."""
    system, java_path = _hadoop_path(spark, path)
    if not system.exists(java_path):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(java_path))


def exists(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder."""
    system, java_path = _hadoop_path(spark, path)
    return system.exists(java_path)


def touch(spark: SparkSession, path: str) -> None:
    """Makes an empty file: it is there or not, but never there in part."""
    system, java_path = _hadoop_path(spark, path)
    system.create(java_path, True).close()


def rename(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a name that is free, in the same file system; FileExistsError where it is taken."""
    system, java_path = _hadoop_path(spark, path)
    _, java_to = _hadoop_path(spark, to)
    if system.exists(java_to):
        raise FileExistsError(to)
    system.mkdirs(java_to.getParent())
    if not system.rename(java_path, java_to):
        raise OSError(f"cannot rename {path} to {to}")


def beside(path: str, label: str) -> str:
    """A new path next to ``path``, in a folder name that readers skip."""
    above, _, name = path.rstrip("/").rpartition("/")
    return f"{above}/_{label}-{name}-{uuid4().hex}"


def replace(spark: SparkSession, path: str, by: str) -> None:
    """Puts the folder ``by`` in the place of ``path`` with two renames; what was there goes afterwards."""
    old = beside(path, "replaced")
    had = exists(spark, path)
    if had:
        rename(spark, path, old)
    rename(spark, by, path)
    if had:
        delete(spark, old)


def file_states(spark: SparkSession, path: str) -> str:
    """Names, sizes and times of the files that a path or pattern stands for: another text once one of them changes."""
    system, java_path = _hadoop_path(spark, path)
    found = []
    for status in system.globStatus(java_path) or []:
        files = system.listFiles(status.getPath(), True)
        while files.hasNext():
            file = files.next()
            found.append(f"{file.getPath()} {file.getLen()} {file.getModificationTime()}")
    return "\n".join(sorted(found))


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder of a run, and the folder above it if that is an empty ``_scratch``."""
    system, java_path = _hadoop_path(spark, path)
    system.delete(java_path, True)
    above = java_path.getParent()
    if above.getName() == "_scratch" and not child_names(spark, above.toString()):
        system.delete(above, False)


def job_session(spark: SparkSession, zone: str | None) -> SparkSession:
    """A session of a job's own with the caller's runtime settings and a time zone (None: the caller's).

    Jobs that run at once in other zones do not see one another's, and the caller's
    session is never changed. Views and streaming listeners are those of the new session.
    """
    own = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if key.startswith("spark.sql.") and spark.conf.isModifiable(key) and own.conf.get(key, None) != value:
            own.conf.set(key, value)
    if zone is not None:
        own.conf.set(ZONE, zone)
    return own
