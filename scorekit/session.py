"""Session helpers: a local session for tests and benches, and the shared checkpoint folder.

On a cluster the session is created by the platform; the library only reads
``spark.checkpoint.dir`` from it. A private folder is created only when the
session runs in local mode and the setting is absent (tests, benches).
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Size under which an aggregated side table may be broadcast. Every call site that broadcasts
# measures the table first (see ``operators.joins.sized_join``).
BROADCAST_MAX_BYTES = 64 << 20


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "scorekit",
                  driver_memory: str = "16g", event_log_dir: str | None = None) -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", driver_memory)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.sql.unionOutputPartitioning", "false")
    )
    if event_log_dir:
        builder = (builder.config("spark.eventLog.enabled", "true")
                   .config("spark.eventLog.dir", event_log_dir))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def guard_union_partitioning(spark: SparkSession) -> None:
    """Keep ``spark.sql.unionOutputPartitioning`` off for this session.

    With it on (the Spark 4.1 default), a union of inputs that are hash-partitioned on the same
    keys, feeding an aggregate on those keys, returned every group once per union input on
    ``collect`` in our runs (``count`` was right). Operators that union partitioned results call
    this before building their plans."""
    try:
        if spark.conf.get("spark.sql.unionOutputPartitioning", "true") != "false":
            spark.conf.set("spark.sql.unionOutputPartitioning", "false")
    except Exception:  # noqa: BLE001  (older Spark without the setting)
        pass


CODE_KEY, CODE_DEFAULT, CODE_BYTES = "spark.sql.codegen.hugeMethodLimit", "65535", "8000"


def limit_generated_code(spark: SparkSession) -> None:
    """Let a stage whose generated method is over 8,000 bytes run by its single expressions, for this session.

    HotSpot does not compile longer methods: a projection of 60 columns then runs interpreted, several times
    slower. A limit of the session's own stays."""
    if spark.conf.get(CODE_KEY, CODE_DEFAULT) == CODE_DEFAULT:
        spark.conf.set(CODE_KEY, CODE_BYTES)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, registering it with the SparkContext.

    Reads ``spark.checkpoint.dir`` from the session. Only a local-mode session without the
    setting gets a fresh private folder; a cluster session without it is an error, since a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for iterative jobs")
        configured = tempfile.mkdtemp(prefix="scorekit-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", configured)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


_TRACKED: list = []


def keep(df):
    """Persist an intermediate that an operator reads more than once, and remember it so that
    ``release_cached`` can free it; a long-lived session then holds at most one query's
    intermediates. A released frame that is used again is recomputed from its lineage."""
    out = df.persist()
    _TRACKED.append(out)
    return out


def kept_frames() -> int:
    """Number of frames kept so far; see ``keep_alone``."""
    return len(_TRACKED)


def keep_alone(df, since: int):
    """Persist and compute ``df``, then free the frames that were kept ``since`` that number to build it: each is a copy of
    the rows that takes the room of what is fitted on ``df``."""
    out = df.persist()
    out.count()
    release_cached(since)
    _TRACKED.append(out)
    return out


def release_cached(since: int = 0) -> None:
    """Free the kept frames, or those kept ``since`` that number."""
    while len(_TRACKED) > since:
        try:
            _TRACKED.pop().unpersist()
        except Exception:  # noqa: BLE001  (session already stopped)
            pass


def cut_lineage(df):
    """Reliable checkpoint (never a local one): survives executor loss."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
