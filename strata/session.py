"""Session settings the operators rely on, and the shared working folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import SparkSession

# Runtime SQL settings: timestamps are compared and printed in UTC, and Spark 4's
# ANSI mode stays on (operators use try_* functions wherever the source data may be dirty).
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",  # narrow shuffled rows become wide ones, which tasks sort
    "spark.sql.variant.allowDuplicateKeys": "true",  # of a repeated JSON key the last value counts
    "spark.sql.codegen.hugeMethodLimit": "8000",  # the JVM never compiles longer methods; wide projections are split instead
    "spark.sql.maxMetadataStringLength": "2000",  # plans name their partition filters whole
    "spark.sql.parquet.pushdown.inFilterThreshold": "200",  # values of small key look-ups reach the Bloom filters
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings the library assumes (idempotent)."""
    for key, value in SQL_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def _checkpoint_root(spark: SparkSession) -> str | None:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    try:
        conf_root = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
        if conf_root:
            return conf_root
        return spark.sparkContext.getCheckpointDir()
    except Exception:  # Spark Connect has no SparkContext
        return None


def workspace(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder under the cluster's shared checkpoint directory.

    The root is read from ``spark.checkpoint.dir``. Only a local-mode session without one
    (tests, benchmarks) gets a private temporary root; on a cluster a machine-local folder
    would be invisible to the executors, so it is an error there.
    """
    root = _checkpoint_root(spark)
    if not root:
        master = spark.conf.get("spark.master", "") or ""
        if not master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        root = tempfile.mkdtemp(prefix="strata-")
        spark.sparkContext.setCheckpointDir(root)
        spark.conf.set("spark.checkpoint.dir", root)
    sub = f"{name or 'work'}-{uuid.uuid4().hex[:12]}"
    path = os.path.join(root.rstrip("/"), sub) if "://" not in root else f"{root.rstrip('/')}/{sub}"
    for made in _OPEN:
        made.append(path)
    return path


#: Folders made inside each open :func:`scratch`.
_OPEN: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Delete the working folders that are made inside the block when it ends, also by an error.

    Write or collect results inside: frames that read these folders cannot be used after it.
    """
    from strata.sources import files

    made: list[str] = []
    _OPEN.append(made)
    try:
        yield
    finally:
        _OPEN[:] = [m for m in _OPEN if m is not made]
        for path in made:
            files.delete(spark, path)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make sure ``DataFrame.checkpoint()`` has a shared directory to write to."""
    root = _checkpoint_root(spark)
    if not root:
        workspace(spark)  # sets a local root in local mode, raises on a cluster
        root = _checkpoint_root(spark)
    else:
        try:
            if not spark.sparkContext.getCheckpointDir():
                spark.sparkContext.setCheckpointDir(root)
        except Exception:
            pass
    return root


def materialize(df, name: str = "materialized"):
    """Compute a frame once and cut its lineage: a Parquet table in the shared folder.

    Used where one result feeds several jobs (a merge batch, tables under data tests):
    later jobs scan the written files (with column pruning) instead of recomputing the
    plan, and a lost executor does not force a recompute from the source. Unlike
    ``checkpoint(eager=True)`` on an unpersisted frame, which runs the plan once to count
    and again to write, this runs it once.
    """
    spark = df.sparkSession
    path = workspace(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
