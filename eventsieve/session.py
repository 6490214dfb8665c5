"""Session settings and the shared scratch location.

The library never picks a machine-local folder on a cluster: scratch tables
(checkpoints, stream outputs, written intermediate tables) live under the
shared folder named by ``spark.checkpoint.dir``. Only a local-mode session
without that setting (tests, bench) gets a private temp folder.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins at run time (broadcast when the
# measured side is small, split skewed partitions, coalesce small ones).
RECOMMENDED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str = "local[8]", app: str = "eventsieve", shuffle_partitions: int = 8,
                  extra: dict[str, str] | None = None) -> SparkSession:
    b = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for k, v in {**RECOMMENDED_CONF, **(extra or {})}.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared scratch folder; set a temp one only for local sessions without it."""
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        if not spark.sparkContext.getCheckpointDir():
            spark.sparkContext.setCheckpointDir(d)
        return d.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running eventsieve jobs")
    d = tempfile.mkdtemp(prefix="eventsieve-ckpt-")
    spark.conf.set("spark.checkpoint.dir", d)
    spark.sparkContext.setCheckpointDir(d)
    return d


_scopes: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared scratch root (never reused between runs)."""
    root = ensure_checkpoint_dir(spark)
    path = f"{root}/eventsieve/{name}-{uuid.uuid4().hex[:12]}"
    if _scopes:
        _scopes[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, the scratch folders made inside it. For jobs that write their results
    before they return; a frame that is still lazy must not outlive the scope."""
    _scopes.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _scopes.pop():
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def stored(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write an intermediate table to a fresh scratch folder and read it back.

    The lineage is cut, the upstream work runs once, and Spark plans what follows with the
    table's size in bytes (a broadcast is chosen only below its byte threshold). With ``by``, the last
    column, a filter on one of its values reads that value's rows only.
    """
    path = scratch_path(df.sparkSession, name)
    out = df.write.mode("overwrite")
    (out.partitionBy(by) if by else out).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
