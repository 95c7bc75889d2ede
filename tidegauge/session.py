"""Session defaults and the shared folder for checkpoints."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Settings that change results or are needed by the stateful processors. They
# are all runtime settings, so they can be applied to a session made elsewhere.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Divide a hot key also where its join feeds an aggregate on the same key.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators rely on; returns the session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "tidegauge",
                  shuffle_partitions: int = 8, memory: str = "8g",
                  extra: dict[str, str] | None = None) -> SparkSession:
    """A single-machine session for tests and benchmarks. On a cluster, make the
    session with spark-submit and pass it to `configure`."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]").appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.unix.domain.socket.enabled", "true")
    )
    spark = builder.config(map=extra or {}).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


_LOCAL_ROOTS: dict[str, str] = {}


def _local_root(spark: SparkSession) -> str:
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="tidegauge-")
        atexit.register(shutil.rmtree, _LOCAL_ROOTS[app], ignore_errors=True)
    return _LOCAL_ROOTS[app]


def shared_dir(spark: SparkSession, name: str, allow_local: bool = True) -> str:
    """A new path below the folder the cluster names in spark.checkpoint.dir. Where the session
    names none, a temporary folder serves a session with a local master, whose tasks all run in
    one process, and ends with that process; other sessions are refused."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if not allow_local or not re.fullmatch(r"local(\[.*\])?", master):
            raise RuntimeError("name a folder that all executors share in spark.checkpoint.dir")
        root = _local_root(spark)
    return f"{root.rstrip('/')}/{name}-{os.urandom(6).hex()}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back, so that
    several uses compute it once and a lost executor does not lose it."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# What may be broadcast: bytes of the rows as they are sent.
MAX_BROADCAST_BYTES = 64 << 20


def fits_broadcast(df: DataFrame, max_rows: int, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether a table has at most so many rows and bytes. At most `max_rows` + 1 rows are
    looked at; strings and bytes count with their length, other columns with 16 bytes."""
    wide = [c for c, t in df.dtypes if t in ("string", "binary")]
    size = F.lit(16 * len(df.columns)).cast("bigint")
    for c in wide:
        size = size + F.coalesce(F.octet_length(F.col(c).cast("binary")), F.lit(0))
    rows, total = df.limit(max_rows + 1).agg(F.count("*"), F.sum(size)).first()
    return rows <= max_rows and (total or 0) <= max_bytes
