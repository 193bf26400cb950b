"""Session construction and shared scratch locations.

Scratch data (staged drops, change logs, versioned table directories) goes
under the shared folder the cluster names in ``spark.checkpoint.dir``.  A
machine-local temporary folder is used only when the session names none and
runs in one process (``local`` masters); any other session must name one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import SparkSession

_FALLBACK_ROOT: dict[int, str] = {}


def build_session(master: str | None = None, app: str = "tablewright",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A session configured the way the operators expect: UTC, AQE with skew
    handling, no UI.  ``master`` is only set for local runs; on a cluster the
    launcher decides."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # parquet drops written by one job are read by the next one
        "spark.sql.sources.partitionOverwriteMode": "static",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scale_conf(input_bytes: int, partition_bytes: int = 512 * 1024 * 1024,
               min_partitions: int = 200, max_partitions: int = 200_000) -> dict[str, str]:
    """Shuffle sizing for a job reading about ``input_bytes``: enough initial
    shuffle partitions that each holds about ``partition_bytes`` (AQE can
    coalesce small partitions afterwards but never splits large ones except
    for skew), and the same advisory size for AQE.  Pass the result as
    ``build_session(extra=...)`` or set it on the cluster."""
    n = max(min_partitions, min(max_partitions, -(-int(input_bytes) // partition_bytes)))
    return {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes // 2),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(256 * 1024 * 1024),
    }


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for scratch tables and checkpoints.

    Read from the session (``spark.checkpoint.dir`` or an already-set
    SparkContext checkpoint dir).  When neither is set and the master is
    ``local``, a fresh local folder is created once per session and
    registered as the checkpoint dir, so ``DataFrame.checkpoint()`` works
    too.  On any other master that is an error: executors would write to
    their own disks."""
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a SparkContext (Spark Connect)
        sc = None
    conf_dir = (sc.getConf().get("spark.checkpoint.dir", None) if sc is not None
                else spark.conf.get("spark.checkpoint.dir", None))
    if conf_dir:
        return conf_dir.rstrip("/")
    if sc is not None and sc.getCheckpointDir():
        return sc.getCheckpointDir().rstrip("/")
    master = sc.master if sc is not None else spark.conf.get("spark.master", "")
    if not re.match(r"local(\[|$)", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that driver and executors share (master {master!r})")
    key = id(sc if sc is not None else spark)
    if key not in _FALLBACK_ROOT:
        # all in one process: a local folder is shared
        root = tempfile.mkdtemp(prefix="tablewright-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir()
        _FALLBACK_ROOT[key] = root.rstrip("/")
    return _FALLBACK_ROOT[key]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh, unique directory path under the checkpoint root.  Nothing is
    created; writers create it."""
    return f"{checkpoint_root(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme so plain-Python helpers (tests) can list it."""
    if path.startswith("file://"):
        return path[len("file://"):]
    if path.startswith("file:"):
        return path[len("file:"):]
    return path


def _file_system(spark: SparkSession, path: str):
    """Hadoop's file system for a path, whatever store it is in."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a directory; none if there is no such directory."""
    fs, p = _file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def put_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with its content in one step, unless there is one of
    that name: of several writers exactly one gets True.  The content is
    written aside first and then linked (local files) or renamed without
    overwriting.  A store must offer such a rename, as HDFS does."""
    fs, p = _file_system(spark, path)
    jvm = spark._jvm
    fs.mkdirs(p.getParent())
    aside = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}-{uuid.uuid4().hex}")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            def local(x):
                return jvm.java.io.File(x.toUri().getPath()).toPath()
            jvm.java.nio.file.Files.createLink(local(p), local(aside))
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
            none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), spark._jsc.hadoopConfiguration()).rename(aside, p, none)
        return True
    except Exception as e:
        if "AlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(aside, False)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's content."""
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def default_parallelism(spark: SparkSession) -> int:
    try:
        return max(1, int(spark.sparkContext.defaultParallelism))
    except Exception:  # pragma: no cover - connect sessions
        return max(1, os.cpu_count() or 1)
