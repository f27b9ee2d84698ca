"""Tables that a job writes for itself, in the session's shared folder.

Spark keeps a shuffle's files until the driver's garbage collector finds them
unused, so the shuffles of a long plan, and of the plans before it, add up on
disk.  A step written here as a table drops its shuffle files when it is
written; a large step is made part after part, so that they are those of one part.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir

DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
ROWS_A_PART = 32_000_000


def job_dir(spark: SparkSession, name: str, run_id: str | None = None) -> str:
    """A folder for a job's checkpoint and sink inside the session's
    ``spark.checkpoint.dir`` (the shared folder on a cluster).  A long-lived
    job passes a fixed ``run_id`` so restarts resume from its checkpoint;
    one-off runs get a fresh folder."""
    rid = run_id or uuid.uuid4().hex[:12]
    return os.path.join(ensure_checkpoint_dir(spark), "streams", f"{name}-{rid}")


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """A write made inside drops its shuffle files when it ends (its plan is its own: nothing reads them later)."""
    before = spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(DROP_SHUFFLES)
        else:
            spark.conf.set(DROP_SHUFFLES, before)


def stored_at(df: DataFrame, path: str, mode: str = "error") -> DataFrame:
    """``df`` as a table at ``path``."""
    with shuffles_dropped(df.sparkSession):
        df.write.mode(mode).option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in a fresh job folder: computed once, however often it is read."""
    return stored_at(df, job_dir(df.sparkSession, name))


def stored_parts(step: Callable[..., DataFrame], frames: Sequence[DataFrame], keys: Sequence[str], path: str) -> DataFrame:
    """``step(*frames)`` as a table at ``path``, a part of about ``ROWS_A_PART`` rows after the other.

    A part holds the rows of some values of ``keys``, by a hash, so every key by which ``step`` brings
    rows together must hold these columns.  The frames are read once for each part and should be tables."""
    with shuffles_dropped(frames[0].sparkSession):
        parts = max(1, -(-sum(f.count() for f in frames) // ROWS_A_PART))
    for k in range(parts):
        own = [f.filter(F.pmod(F.xxhash64(*keys), F.lit(parts)) == k) for f in frames] if parts > 1 else frames
        out = stored_at(step(*own), path, "append")
    return out
