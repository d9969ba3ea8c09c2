"""Session construction and shared scratch storage.

Scratch data (fixtures, stream checkpoints, sink tables) always lives under
the cluster's shared checkpoint folder (``spark.checkpoint.dir``), never in a
machine-local temp folder.  Only when the session has no checkpoint folder at
all (a bare local test session) do we create one.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job needs; see README "Session settings".
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "quarry", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_session_conf(spark)
    return spark


def apply_session_conf(spark: SparkSession) -> None:
    """Runtime SQL settings the operators rely on, and the library shipped to
    the executors' Python workers (idempotent)."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Broadcast only proven-small sides: the operators broadcast what they
    # have counted, and AQE may broadcast what it has *measured* at runtime;
    # no broadcast from file-size estimates (compressed sizes understate).
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    ship_package(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Zip this package and add it to the SparkContext (``addPyFile``), so
    Python workers can import it for UDFs and the Python data source --
    the runtime equivalent of ``spark-submit --py-files``."""
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED:
        return
    import zipfile

    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = _checkpoint_root(spark)
    if "://" in root and not root.startswith("file:"):
        # addPyFile serves the file from the driver to every executor, so a
        # driver-side build file is enough when the shared root is remote.
        target = os.path.join(tempfile.mkdtemp(prefix="quarry-pyfiles-"), "quarry.zip")
    else:
        target = os.path.join(shared_dir(spark, "pyfiles"), "quarry.zip")
    tmp = target + ".tmp"
    with zipfile.ZipFile(tmp, "w", zipfile.ZIP_DEFLATED) as zf:
        for root, dirs, files in os.walk(pkg_dir):
            dirs[:] = [d for d in dirs if d != "__pycache__"]
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    zf.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    os.replace(tmp, target)
    sc.addPyFile(target)
    _SHIPPED.add(app)


def _checkpoint_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir", None)
    if root:
        return root
    current = sc.getCheckpointDir()
    if current:
        return current
    # Unset: on one machine (tests), create one and register it, so that
    # DataFrame.checkpoint() and our scratch data share the same place.  On a
    # cluster every executor would see a folder of its own.
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="quarry-ckpt-")
    sc.setCheckpointDir(root)
    return root


_RUN_ID = uuid.uuid4().hex[:12]


def shared_dir(spark: SparkSession, *parts: str) -> str:
    """A fresh path under the shared checkpoint folder for this process run.

    Paths are unique per process (run id) so that no run ever has to delete
    another run's files.
    """
    root = _checkpoint_root(spark)
    if root.startswith("file:"):
        root = root[len("file:"):]
    path = os.path.join(root, "quarry", _RUN_ID, *parts)
    if "://" not in path:
        os.makedirs(path, exist_ok=True)
    return path


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure DataFrame.checkpoint() has a shared target; return it."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(os.path.join(_checkpoint_root(spark), "quarry-rdd"))
    return sc.getCheckpointDir()


def materialize(df):
    """Cut lineage with a reliable checkpoint in the shared checkpoint folder
    (survives executor loss, unlike local checkpoints).  Use before several
    passes over an expensive derived DataFrame, e.g. iterative model fits."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder of any store that Spark reads; none if it is missing."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    if not fs.exists(target):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(target))


def is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path``, in any store that Spark reads, is a folder."""
    sc = spark.sparkContext
    target = sc._jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    return fs.exists(target) and fs.getFileStatus(target).isDirectory()


_TABLES: list[tuple[str, SparkSession]] = []


def track(path: str, spark: SparkSession) -> None:
    """Let ``remove_tables`` remove the table at ``path``."""
    _TABLES.append((path, spark))


def write_table(df, name: str):
    """Write ``df`` once as Parquet in the shared folder and read it back.

    For small intermediate tables that several branches of a plan read (cuts,
    totals): all branches see the same rows, and the lineage is cut.
    ``remove_tables`` removes the folders once the results are computed.
    """
    path = f"{shared_dir(df.sparkSession, 'tables')}/{name}-{uuid.uuid4().hex[:8]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    track(path, df.sparkSession)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove_tables() -> None:
    """Remove what ``write_table`` has written in this process; results that
    still read it must have been computed."""
    while _TABLES:
        path, spark = _TABLES.pop()
        sc = spark.sparkContext
        if sc._jsc is None:                      # the session has ended
            continue
        target = sc._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(sc._jsc.hadoopConfiguration()).delete(target, True)
