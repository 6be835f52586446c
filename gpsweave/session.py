"""Session settings the operators rely on, and the shared checkpoint folder."""

from __future__ import annotations

import os
import sys
import tempfile
import zipfile

from pyspark import cloudpickle
from pyspark.sql import SparkSession

# Settings every query of this package assumes. Event time is parsed as UTC;
# AQE coalesces small shuffles and splits skewed join partitions at run time.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # rows go to Python in batches of a few MB, however long their texts are
    "spark.sql.execution.arrow.maxBytesPerBatch": str(4 << 20),
    # many folders are listed by a few hundred tasks, not by one task for each of up to 10,000
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "256",
    # hundreds of thousands of small files are read by a few thousand tasks, not by one for every few of them
    "spark.sql.files.maxPartitionNum": "4096",
    # stateful processors keep several state variables (column families)
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers (state machine,
    stateful processors): zip it once per application and add it with
    ``addPyFile``, as ``--py-files`` would. Only code goes this way."""
    # the streaming Python runners do not see added py-files: send this
    # package's functions and classes by value in every pickled closure
    if __package__ not in getattr(cloudpickle.cloudpickle, "_PICKLE_BY_VALUE_MODULES", ()):
        cloudpickle.register_pickle_by_value(sys.modules[__package__])
    try:
        sc = spark.sparkContext
        app = sc.applicationId
    except Exception:          # a Spark Connect session has no SparkContext
        sc, app = None, f"connect-{id(spark)}"
    if app in _SHIPPED:
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="gpsweave-code-"), "gpsweave.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for root, _dirs, files in os.walk(pkg_dir):
            if "__pycache__" in root:
                continue
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(root, f)
                    z.write(full, os.path.relpath(full, os.path.dirname(pkg_dir)))
    if sc is not None:
        sc.addPyFile(out)
    else:
        spark.addArtifacts(out, pyfile=True)
    _SHIPPED.add(app)


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators need to an existing session
    and ship the package to the Python workers."""
    for k, v in SESSION_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)
    ship_package(spark)
    return spark


def build_session(master: str | None = None, app: str = "gpsweave",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    """Session for tests, bench and local runs (UI off, UTC, AQE on)."""
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(SESSION_CONF)
    conf["spark.ui.enabled"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named in ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is used as is; without
    it a cluster session is refused, since executors don't share local folders.
    A session in one process (``local[...]``, tests) gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.conf.get("spark.master", "")
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("spark.checkpoint.dir is unset: name a folder that driver and executors share")
        d = tempfile.mkdtemp(prefix="gpsweave-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    try:
        spark.sparkContext.setCheckpointDir(d)
    except Exception:          # Spark Connect: the server reads spark.checkpoint.dir
        pass
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A sub-folder of the shared checkpoint folder for written tables."""
    return os.path.join(checkpoint_dir(spark), name)
