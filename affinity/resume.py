"""Restart points of a job and the joint publication of its outputs.

``resumable_stages`` gives every table that ``write_stage`` writes inside its block a fixed place,
``<shared folder>/affinity-jobs/<job>/<step>-<name>``, and, once the table is complete, a manifest
with the job's fingerprint and the table's schema. A later run of the same job finds the manifests: as
long as its steps have been completed, from the same inputs with the same parameters, their tables are
read and not computed. The first step without a fitting manifest is computed, and so are all behind
it, since row ids given by an earlier run's table would not fit a new one.

``replace_outputs`` writes all outputs of a job beside the old ones, notes that they are complete in a
journal, and moves them into place. A run that fails before the journal leaves all old outputs as they
were; one that fails behind it is finished by ``finish_publication`` (every publication begins with it), so
that no mixture of old and new stays.

Both only use files of Hadoop file systems and their renames, on the driver; the number of operations
depends on the number of steps and outputs, not on the data.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from affinity.session import ensure_checkpoint_dir, redirect_stages

#: Part of every fingerprint: raise it when a step computes something else from the same inputs.
STEPS_VERSION = 2
JOURNAL = "journal.json"
MANIFEST = "_MANIFEST.json"


# -------------------------------------------------------------------------------- files


class Files:
    """The few file operations used here, on the file system that a path names."""

    def __init__(self, spark: SparkSession):
        self._jvm, self._conf = spark._jvm, spark._jsc.hadoopConfiguration()

    def _at(self, path: str):
        p = self._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self._conf), p

    def exists(self, path: str) -> bool:
        fs, p = self._at(path)
        return fs.exists(p)

    def delete(self, path: str) -> None:
        fs, p = self._at(path)
        fs.delete(p, True)

    def names(self, path: str) -> list[str]:
        fs, p = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []

    def rename(self, path: str, to: str) -> None:
        fs, p = self._at(path)
        target = self._jvm.org.apache.hadoop.fs.Path(to)
        fs.mkdirs(target.getParent())
        if not fs.rename(p, target):
            raise OSError(f"cannot rename {path} to {to}")

    def read(self, path: str) -> str | None:
        fs, p = self._at(path)
        if not fs.exists(p):
            return None
        stream = fs.open(p)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def write(self, path: str, text: str) -> None:
        """The file appears with its whole text or not at all."""
        part = f"{path}.{uuid.uuid4().hex[:8]}.part"
        fs, p = self._at(part)
        stream = fs.create(p, True)
        stream.write(text.encode())
        stream.close()
        self.delete(path)
        self.rename(part, path)


# ------------------------------------------------------------------------- restart points


def job_root(spark: SparkSession) -> str:
    """The folder of all jobs: in ``spark.checkpoint.dir`` itself, as the folder that Spark
    makes in it for one application is not found again by the next."""
    own = ensure_checkpoint_dir(spark)
    base = spark.conf.get("spark.checkpoint.dir", None) or own.rstrip("/").rpartition("/")[0]
    return f"{base.rstrip('/')}/affinity-jobs"


def input_fingerprint(spark: SparkSession, *paths: str) -> str:
    """Digest of the names, sizes and times of all files under the paths; their contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(list(paths))
    one = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    row = files.agg(F.count(F.lit(1)), F.sum("length"), F.sum(one)).first()
    return hashlib.sha256(repr(tuple(row)).encode()).hexdigest()


class JobStages:
    """The tables of one job, step by step in the order in which they are asked for."""

    def __init__(self, spark: SparkSession, job: str, fingerprint: str, on_step: Callable[[str, bool], None] | None):
        self.spark, self.files, self.on_step = spark, Files(spark), on_step
        self.folder = f"{job_root(spark)}/{job}"
        self.fingerprint = hashlib.sha256(f"{STEPS_VERSION}|{spark.version}|{fingerprint}".encode()).hexdigest()
        self.step, self.resuming = 0, True

    def stage(self, df: DataFrame, name: str) -> DataFrame:
        """The step's table: the one of an earlier run where its manifest fits, else computed and written."""
        self.step += 1
        place = f"{self.folder}/{self.step:03d}-{name}"
        data, manifest = f"{place}/data", f"{place}/{MANIFEST}"
        want = json.dumps({"step": self.step, "name": name, "fingerprint": self.fingerprint, "schema": df.schema.json()})
        self.resuming = self.resuming and self.files.read(manifest) == want
        if not self.resuming:
            # The old mark goes first, so that it never stands beside new data.
            self.files.delete(place)
            df.write.mode("overwrite").parquet(data)
            self.files.write(manifest, want)
        if self.on_step:
            self.on_step(name, self.resuming)
        return self.spark.read.schema(df.schema).parquet(data)

    def forget(self) -> None:
        self.files.delete(self.folder)


@contextmanager
def resumable_stages(
    spark: SparkSession, job: str, fingerprint: str, on_step: Callable[[str, bool], None] | None = None
) -> Iterator[JobStages]:
    """Inside the block ``write_stage`` writes restart points of the job, or reads them.

    ``fingerprint`` stands for everything that the tables depend on. ``on_step(name, reused)`` is told of
    each step when its table is there. The tables are deleted when the block ends without an error, and
    stay when it does not. Two runs of one job must not overlap.
    """
    stages = JobStages(spark, job, fingerprint, on_step)
    with redirect_stages(stages.stage):
        yield stages
    stages.forget()


# --------------------------------------------------------------------------- publication


def _attempts(files: Files, base: str) -> list[str]:
    return [f"{base}/{n}" for n in files.names(base) if n.startswith("_publish-")]


def _swap(files: Files, base: str, attempt: str) -> None:
    """Move complete outputs into place; it can be repeated after any interruption."""
    for name in json.loads(files.read(f"{attempt}/{JOURNAL}")):
        new, place = f"{attempt}/new/{name}", f"{base}/{name}"
        if files.exists(new):
            if files.exists(place):
                files.rename(place, f"{attempt}/old/{name}")
            files.rename(new, place)
    files.delete(attempt)


def finish_publication(spark: SparkSession, base: str, drop_unfinished: bool = False) -> None:
    """Bring publications of complete outputs to their end. ``drop_unfinished`` also deletes what
    killed runs have left behind; only for a folder to which nothing is being written."""
    files, base = Files(spark), base.rstrip("/")
    for attempt in _attempts(files, base):
        if files.exists(f"{attempt}/{JOURNAL}"):
            _swap(files, base, attempt)
        elif drop_unfinished:
            files.delete(attempt)


def replace_outputs(spark: SparkSession, base: str, writers: dict[str, Callable[[str], None]]) -> dict[str, str]:
    """Write every output of ``base`` and publish them together; returns their paths by name.

    A writer stores its output at the path that it is given. Old outputs stay until all new ones are
    complete, so a writer may also read what it replaces.
    """
    files, base = Files(spark), base.rstrip("/")
    finish_publication(spark, base)
    attempt = f"{base}/_publish-{uuid.uuid4().hex[:12]}"
    try:
        for name, write in writers.items():
            write(f"{attempt}/new/{name}")
    except BaseException:
        files.delete(attempt)
        raise
    files.write(f"{attempt}/{JOURNAL}", json.dumps(list(writers)))
    _swap(files, base, attempt)
    return {name: f"{base}/{name}" for name in writers}
