"""Session settings and the shared scratch folder.

All settings the library relies on are set here once: UTC session time zone,
ANSI mode, adaptive execution (coalescing, skew-join splitting and runtime
broadcast).  Partition overwrite mode is given per write (dynamic for
partition-wise upserts and loads, static for full refreshes), never globally.
"""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, app: str = "gridmart",
                shuffle_partitions: int | None = None,
                extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library's settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    apply_settings(spark)
    return spark


def apply_settings(spark: SparkSession) -> None:
    """Apply the runtime-settable subset of SETTINGS to an existing session."""
    for key, value in SETTINGS.items():
        if spark.conf.isModifiable(key):
            spark.conf.set(key, value)
    if spark.conf.get("spark.sql.session.timeZone") not in ("UTC", "Etc/UTC", "Z"):
        raise RuntimeError("the session time zone must be UTC")
    ship_package(spark)


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once for an application.

    Functions that run in tasks import it there.  Nothing is sent when it was
    already shipped as an archive (``--py-files``).
    """
    sc, package = spark.sparkContext, Path(__file__).resolve().parent
    if getattr(sc, "_gridmart_shipped", False) or not package.is_dir():
        return
    archive = Path(tempfile.mkdtemp(prefix="gridmart-code-")) / "gridmart-package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    sc.addPyFile(str(archive))
    sc._gridmart_shipped = True


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is.  Only
    on a ``local`` or ``local[...]`` master, where driver and tasks share one
    machine, may it be unset: a private folder is then created and set.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if current:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(current)
        return current.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="gridmart-ckpt-"))
    return sc.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    root = checkpoint_root(spark)
    return f"{root}/gridmart/{name}-{uuid.uuid4().hex[:12]}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through Hadoop's FileSystem, so it works on any store."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def partition_values(spark: SparkSession, path: str, column: str) -> list[str]:
    """The values of a table's partition folders as text, sorted; from a listing of one folder."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(hpath)]
    return sorted(n[len(column) + 1:] for n in names if n.startswith(f"{column}="))


def delete_path(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.exists(hpath):
        fs.delete(hpath, True)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """Complete versions of a small table, oldest first."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(hpath):
        return []
    found = [s.getPath() for s in fs.listStatus(hpath) if s.getPath().getName().startswith("v=")]
    done = [v for v in found if fs.exists(jvm.org.apache.hadoop.fs.Path(v, "_SUCCESS"))]
    return sorted(v.toString() for v in done)


def read_version(spark: SparkSession, path: str):
    """The newest complete version of a small table, or None."""
    found = _versions(spark, path)
    return spark.read.parquet(found[-1]) if found else None


def write_version(df, path: str) -> None:
    """Write a small table as a new version; a crash leaves the one before.

    The version before is kept (a running reader may hold it), older ones go.
    """
    spark = df.sparkSession
    found = _versions(spark, path)
    number = int(found[-1].rsplit("v=", 1)[1]) + 1 if found else 1
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/v={number:012d}")
    for old in found[:-1]:
        delete_path(spark, old)


@contextmanager
def staged_copy(df, tag: str):
    """Write ``df`` to a fresh folder under the checkpoint root and yield it
    read back: the lineage is cut there, so later jobs (and retries after a
    lost executor) read the staged files, never the inputs being replaced.

    The folder is removed once the block has succeeded (nothing references
    it then); after a failure it is left for inspection.
    """
    spark = df.sparkSession
    path = scratch_path(spark, tag)
    df.write.mode("overwrite").parquet(path)
    yield spark.read.parquet(path)
    delete_path(spark, path)


def _location(uri: str) -> tuple:
    u = urlparse(uri)
    return (u.scheme or "file", u.netloc, u.path.rstrip("/"))


def reads_path(df, path: str) -> bool:
    """Whether ``df`` reads any file at or under ``path``.

    Decided from the plan's file listing on the driver (no Spark job); a
    missing target cannot be read.
    """
    spark = df.sparkSession
    if not path_exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    scheme, host, root = _location(fs.makeQualified(hpath).toString())
    for f in df.inputFiles():
        s2, h2, p2 = _location(f)
        if s2 == scheme and h2 == host and (p2 == root or p2.startswith(root + "/")):
            return True
    return False


@contextmanager
def staged_copy_if_reads(df, path: str, tag: str):
    """``df`` itself when it does not read ``path``; otherwise a staged copy
    (see :func:`staged_copy`), so replacing ``path`` never deletes files a
    running or retried task still reads.  A full refresh of a big table is
    then written once instead of twice."""
    if reads_path(df, path):
        with staged_copy(df, tag) as staged:
            yield staged
    else:
        yield df


#: Spark's error conditions for a path that is missing or holds no data files.
_ABSENT = {"PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"}


def read_parquet_or_none(spark: SparkSession, path: str):
    """The Parquet table at ``path``, or None when it is missing or holds no
    data files yet (e.g. a first write that failed).  Any other failure to
    read it is raised, so an unreadable table is never taken for absent."""
    from pyspark.errors import AnalysisException
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as exc:
        if exc.getCondition() not in _ABSENT:
            raise
        return None
