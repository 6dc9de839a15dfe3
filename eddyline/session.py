"""Session construction and the shared folder that jobs write scratch tables to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}
_shipped: set[str] = set()


def build_session(app: str = "eddyline", master: str | None = None, **conf: str) -> SparkSession:
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder (``spark.checkpoint.dir``).

    Only a local master may go without one; there a temporary folder stands in.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = _local_roots.setdefault(
            context.applicationId, tempfile.mkdtemp(prefix="eddyline-")
        )
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path in the shared folder that no earlier run has used."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder of our own under the shared folder, and nothing else."""
    root = shared_root(spark).rstrip("/")
    if not path.startswith(f"{root}/") or ".." in path:
        raise ValueError(f"not in the shared folder: {path}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


#: Rows that one task of a CPU-heavy step takes, whatever the size of its input.
ROWS_PER_TASK = 100_000


def tasks_for(rows: int, spark: SparkSession) -> int:
    """One task for every core, and more as the rows grow, so that no task grows with them."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // ROWS_PER_TASK))


def spread(df):
    """Give CPU-heavy steps work for every core when the input is a few small files, and
    tasks of a fixed size when it is a few large ones (columnar files hold many rows).

    A scan with at least as many splits is left alone.
    """
    wanted = tasks_for(df.count(), df.sparkSession)
    return df.repartition(wanted) if df.rdd.getNumPartitions() < wanted else df


def cut_lineage(df):
    """Reliable checkpoint: survives executor loss, unlike the local kind."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in Python workers on other machines.

    Local workers share the driver's files, but not its ``sys.path`` entries, so they
    get it the same way.
    """
    import os
    import zipfile

    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    archive = os.path.join(tempfile.mkdtemp(prefix="eddyline-src-"), "eddyline.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)
