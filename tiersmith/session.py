"""Session settings, input tables and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

# Runtime SQL settings every job in this package relies on. They can be set on a session
# somebody else created, so queries never depend on how the session was built.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A hot join key is cut into several tasks, also where that costs one more exchange.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Only possible while a session is being built. The call-site capture of PySpark costs several
# round trips to the JVM per column expression, which adds up in plans with hundreds of them.
STATIC_CONF = {"spark.python.sql.dataFrameDebugging.enabled": "false"}

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_schemas: dict[str, StructType] = {}
_local_scratch: dict[str, str] = {}
_made: dict[str, list[str]] = {}


def build_session(master: str = "local[*]", app: str = "tiersmith", **conf: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app).config("spark.ui.enabled", "false")
    for key, value in {**STATIC_CONF, **RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """An input table. Its schema is read from the footers once, not in a job per use."""
    path = f"{sf_dir}/{name}.parquet"
    known = _schemas.get(path)
    if known is None:
        df = spark.read.parquet(path)
        _schemas[path] = df.schema
        return df
    return spark.read.schema(known).parquet(path)


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder under the shared folder named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder: on a cluster a machine-local
    path would not be visible to the other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        app = spark.sparkContext.applicationId
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        if app not in _local_scratch:
            _local_scratch[app] = tempfile.mkdtemp(prefix="tiersmith-")
        root = _local_scratch[app]
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    _made.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _remove(spark: SparkSession, path: str) -> None:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def drop_scratch(spark: SparkSession) -> int:
    """Remove all scratch folders this session has made; frames that read them are of no use afterwards.

    Results are lazy, so only the caller knows when they have been read or stored.
    """
    made = _made.pop(spark.sparkContext.applicationId, [])
    for path in made:
        _remove(spark, path)
    return len(made)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query started meanwhile go when it ends, not when the driver happens to collect its garbage.

    A frame that is collected twice is shuffled twice then: for jobs that store what they need again.
    """
    before = spark.conf.get(DROP_SHUFFLES, "false")
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(DROP_SHUFFLES, before)


@contextmanager
def temporary(spark: SparkSession, label: str) -> Iterator[str]:
    """A scratch folder for one step, removed when the step is over, also where it fails."""
    path = scratch_dir(spark, label)
    try:
        yield path
    finally:
        _remove(spark, path)
        _made[spark.sparkContext.applicationId].remove(path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table in the shared folder: several readers, and retried tasks, see the same rows."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
