"""SparkSession helpers.

Library code never creates a session on its own; callers pass one in.  These
helpers exist for tests, the bench and command-line use.
"""

from __future__ import annotations

import os
import shutil
import site
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_SHIPPED: set[str] = set()      # applications that were sent this package

# SQL settings the operators rely on; applied at run time where the launch
# configuration leaves them unset.  ANSI mode makes decimal overflow an error
# instead of a silent NULL; AQE coalesces small shuffle partitions and splits
# skewed sort-merge-join partitions at run time.
DEFAULT_CONF = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # larger scan tasks for big inputs (fewer, ~256 MB splits)
    "spark.sql.files.maxPartitionBytes": "256m",
}


def build_session(master: str | None = None, app: str = "shelfwise",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Session with ``DEFAULT_CONF`` where the launch configuration (spark-submit
    ``--conf``, spark-defaults) leaves a setting unset; ``shuffle_partitions``
    and ``extra`` are explicit and always applied.  The web UI is kept off."""
    builder = SparkSession.builder.appName(app).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    explicit = dict(extra or {})
    if shuffle_partitions:
        explicit["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for k, v in explicit.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    launched = spark.sparkContext.getConf()
    for k, v in DEFAULT_CONF.items():
        if k not in explicit and not launched.contains(k):
            spark.conf.set(k, v)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers, once per application.

    Nothing to do where it is installed, on PYTHONPATH or in the working
    folder; else (it was put on the driver's sys.path alone) Spark sends it.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = [*os.environ.get("PYTHONPATH", "").split(os.pathsep), *site.getsitepackages(), os.getcwd()]
    context = spark.sparkContext
    if root in map(os.path.abspath, filter(None, known)) or context.applicationId in _SHIPPED or \
            not os.path.isdir(root):
        return
    _SHIPPED.add(context.applicationId)
    package = os.path.basename(os.path.dirname(os.path.abspath(__file__)))
    archive = shutil.make_archive(os.path.join(tempfile.mkdtemp(prefix="shelfwise-"), package), "zip", root, package)
    context.addPyFile(archive)


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder named by the cluster (``spark.checkpoint.dir``), for tables between jobs.

    The session's setting wins, then ``fallback``, which must be a shared path
    too.  With neither, a fresh temporary folder is used under a local master,
    which shares it with itself; on a cluster that is an error, never a
    machine-local folder.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir() or fallback
    if not folder:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="shelfwise-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


def staging_dir(spark: SparkSession) -> str:
    """This application's own folder under the shared one; ``release_staging`` deletes it."""
    return f"{checkpoint_dir(spark).rstrip('/')}/shelfwise/{spark.sparkContext.applicationId}"


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; empty if there is none."""
    p, fs = _file_system(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def touch(spark: SparkSession, path: str) -> None:
    """An empty file, with its folders."""
    p, fs = _file_system(spark, path)
    fs.create(p, True).close()


def private_name(path: str) -> str:
    """A name beside ``path``, on the same file system, that readers skip and nobody else has."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/_{name}-{uuid.uuid4().hex}" if folder or path.startswith("/") else f"_{name}-{uuid.uuid4().hex}"


def commit_folder(spark: SparkSession, made: str, path: str) -> bool:
    """Give the folder ``made`` the name ``path`` by one rename; False, and ``made`` is deleted, if the name is taken.

    Of any number of callers with the same ``path`` one wins.  A file in the
    folder tells whose it is afterwards, as some file systems move a folder
    into one that is there instead of refusing.
    """
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    src, fs = _file_system(spark, made)
    dst, _ = _file_system(spark, path)
    mark = f"_made-{uuid.uuid4().hex}"
    touch(spark, f"{made}/{mark}")
    if dst.getParent() is not None:
        fs.mkdirs(dst.getParent())
    error = None
    if not fs.exists(dst):
        rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
        try:
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration()).rename(
                fs.makeQualified(src), fs.makeQualified(dst), gateway.new_array(rename, 0))
        except Py4JJavaError as e:
            error = e
    own = jvm.org.apache.hadoop.fs.Path(dst, mark)
    if fs.exists(own):
        fs.delete(own, False)
        return True
    for stray in (jvm.org.apache.hadoop.fs.Path(dst, src.getName()), src):
        fs.delete(stray, True)
    if error is not None and not fs.exists(dst):
        raise error
    return False


def remove_if_empty(spark: SparkSession, path: str, leftovers: set[str] = frozenset()) -> None:
    """Remove a folder that holds nothing but ``leftovers``; one that got other files meanwhile stays."""
    p, fs = _file_system(spark, path)
    for name in leftovers:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(p, name), True)
    try:
        fs.delete(p, False)                              # not recursive: refuses a folder with files
    except Py4JJavaError:
        pass


def release(spark: SparkSession, path: str) -> None:
    """Delete a table this library wrote between jobs."""
    p, fs = _file_system(spark, path)
    fs.delete(p, True)


def release_staging(spark: SparkSession) -> None:
    """Delete all tables this application wrote between jobs; results built on them must be written by then."""
    release(spark, staging_dir(spark))
