"""Session construction and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings the plans are written for. AQE re-plans joins at runtime: a join side whose
# measured shuffle output is under the broadcast threshold becomes a broadcast join, a
# skewed partition is split, and small shuffle partitions are coalesced.
RECOMMENDED_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # The size bound of every broadcast: static (file sizes) and runtime (measured
    # shuffle output). Larger sides stay shuffle joins.
    "spark.sql.autoBroadcastJoinThreshold": "10m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "10m",
    # Top-n rankings up to this n limit their groups before the shuffle (Spark's default: 1000);
    # ``functions.top_n_per_group`` ranks a larger n in parts.
    "spark.sql.optimizer.windowGroupLimitThreshold": "100000",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(
    cores: int | str = 8, shuffle_partitions: int = 8, app: str = "affinity", event_log_dir: str | None = None
) -> SparkSession:
    """A local session for tests and the benchmark (UI off, loopback only).

    ``event_log_dir`` writes Spark's event log there (read it with tools/stage_times.py).
    """
    b = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.default.parallelism", str(shuffle_partitions))
        .config("spark.sql.files.maxPartitionBytes", "64m")
    )
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    if event_log_dir:
        b = b.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", event_log_dir)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder.

    On a cluster ``spark.checkpoint.dir`` names a shared, fault-tolerant folder; it is
    only read here. Only when it is unset in a local session (tests) a folder is created and
    set; with executors on other machines an unset folder is an error, because each would
    write to its own disk.
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir()
    if not d:
        d = spark.conf.get("spark.checkpoint.dir", None)
        if not d:
            if not re.fullmatch(r"local(\[.*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            d = tempfile.mkdtemp(prefix="affinity-ckpt-")
        sc.setCheckpointDir(d)
        d = sc.getCheckpointDir() or d
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    path = f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"
    for scope in _recording:
        scope.paths.append(path)
    return path


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


def write_stage(df, name: str):
    """Materialise ``df`` as Parquet in the shared checkpoint folder and read it back.

    Used where one result feeds several branches of a plan (the pruned neighbour graph
    is read three times by the path search) or where a later step should not replay the
    quadratic pair expansion. The table lives under ``spark.checkpoint.dir`` (shared
    storage on a cluster), so it survives the loss of any executor, cuts the lineage,
    and gives the planner exact sizes for its join choices.
    """
    if _redirected:
        return _redirected[-1](df, name)
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    # The schema is known: reading it back needs no footer inference.
    return spark.read.schema(df.schema).parquet(path)


#: Bytes, as they are stored, of signals or of user-item rows that a task takes at most: some million rows, which are
#: many times as large in memory.
ROWS_BYTES = "16m"


@contextmanager
def _settings(spark: SparkSession, conf: dict[str, str]) -> Iterator[None]:
    """The settings inside the block; afterwards they are as they were."""
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def shuffle_to(spark: SparkSession, partitions: int):
    """Let every shuffle of what is run inside the block have ``partitions`` partitions, none merged, and scans small parts.

    For a stage whose rows multiply behind a shuffle: AQE merges partitions by the bytes that it has measured
    before that.
    """
    return _settings(
        spark,
        {
            "spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.maxPartitionBytes": ROWS_BYTES,
        },
    )


def write_rows(df: DataFrame, name: str) -> DataFrame:
    """``write_stage`` of a table with short rows that are large in memory: AQE merges fewer of them into a task."""
    with _settings(df.sparkSession, {"spark.sql.adaptive.advisoryPartitionSizeInBytes": ROWS_BYTES}):
        return write_stage(df, name)


_recording: list["StageScope"] = []
_redirected: list[Callable] = []


@contextmanager
def redirect_stages(stage: Callable) -> Iterator[None]:
    """Let ``stage(df, name)`` write the tables of ``write_stage`` inside the block (``affinity.resume``)."""
    _redirected.append(stage)
    try:
        yield
    finally:
        _redirected.remove(stage)


class StageScope:
    """The scratch folders made inside a block, kept as long as a held result reads them."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: list[str] = []
        self._held: list[tuple[DataFrame, set[str]]] = []

    def reads(self, df: DataFrame) -> set[str]:
        """The scope's folders that a DataFrame reads from."""
        folders = {_bare(f).rpartition("/")[0] + "/" for f in df.inputFiles()}
        return {p for p in self.paths if any(f.startswith(_bare(p) + "/") for f in folders)}

    def hold(self, df: DataFrame) -> DataFrame:
        """Keep what ``df`` reads until it is released."""
        self._held.append((df, self.reads(df)))
        return df

    def release(self, df: DataFrame) -> None:
        """``df`` has been stored: what no other held result reads goes."""
        at = next(i for i, (held, _) in enumerate(self._held) if held is df)
        del self._held[at]
        self.trim()

    def trim(self) -> None:
        """Delete the folders that no held result reads, as the tables that led to the last ones."""
        live = set().union(*(paths for _, paths in self._held))
        for p in self.paths:
            if p not in live:
                _delete(self.spark, p)
        self.paths = [p for p in self.paths if p in live]


def _bare(path: str) -> str:
    """A path without its scheme and host."""
    return re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", path).rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


@contextmanager
def temporary_stages(spark: SparkSession) -> Iterator[StageScope]:
    """Delete the scratch folders that are made inside the block (staged tables above all) when it ends.

    For jobs that store their results before the end; a DataFrame that is still to be read
    from staged tables must not outlive the block. Inside, ``hold`` the results and ``trim`` to free at once what
    led to them, and ``release`` each when it is stored.
    """
    scope = StageScope(spark)
    _recording.append(scope)
    try:
        yield scope
    finally:
        _recording.remove(scope)
        for p in scope.paths:
            _delete(spark, p)


def store_result(spark: SparkSession, build: Callable[[], DataFrame], store: Callable[[DataFrame], object]):
    """Build a result, store it and leave no scratch folder: those that led to it go before it is computed."""
    with temporary_stages(spark) as scope:
        df = scope.hold(build())
        scope.trim()
        return store(df)
