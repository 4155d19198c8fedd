"""What the operators share: the words of a text, shared folders, written steps."""

from __future__ import annotations

import atexit
import ctypes
import functools
import shutil
import sys
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_trim = getattr(ctypes.CDLL(None), "malloc_trim", None) if sys.platform.startswith("linux") else None

#: A word: a run of anything but space and the control characters from tab to return.
WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_or_empty(text: str | Column = "text") -> Column:
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z and nothing else, whatever the locale."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors reach: ``spark.checkpoint.dir`` of the session.

    Only a session on one machine that names none gets a temporary folder instead.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="feedworks-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


#: Folders of steps, by application, that are still there.
_steps: dict[str, list[str]] = {}


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder for a step. It goes with the session, or with ``steps_removed`` around its making."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _steps.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def remove_steps(spark: SparkSession, since: int = 0) -> None:
    """Delete the folders of steps, all or those made after the first ``since``. Frames that read them end here."""
    made = _steps.get(spark.sparkContext.applicationId, [])
    for name in made[since:]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(name)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    del made[since:]


@contextmanager
def steps_removed(spark: SparkSession) -> Iterator[None]:
    """For the time of a ``with`` in which a result is made and written; its steps are deleted at the end."""
    before = len(_steps.get(spark.sparkContext.applicationId, []))
    try:
        yield
    finally:
        remove_steps(spark, before)


@atexit.register
def _remove_what_is_left() -> None:
    spark = SparkSession.getActiveSession()
    if spark is not None and spark.sparkContext._jsc is not None:
        remove_steps(spark)


def written(df: DataFrame, name: str, batch_rows: int | None = None) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: lineage ends here.

    A lost executor costs later steps a new read of these files, never the work before.
    ``batch_rows`` is how many rows Python workers get at a time, for rows that are large: the
    session's own setting is back when the table is written.
    """
    spark, key = df.sparkSession, "spark.sql.execution.arrow.maxRecordsPerBatch"
    path, before = fresh_path(spark, name), spark.conf.get(key)
    if batch_rows is not None:
        spark.conf.set(key, batch_rows)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(key, before)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.Array | pa.RecordBatch, rows: int = 256) -> Iterator[pa.Array | pa.RecordBatch]:
    """A batch in parts of a few rows, so that only a part of it is held as Python objects."""
    for at in range(0, len(batch), rows):
        yield batch.slice(at, rows)
    give_back()


def give_back() -> None:
    """Return freed memory to the system: Python workers live on from task to task.

    Arrow is asked to, and so is the C library where it can (glibc).
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def free_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, for columns that only pass through."""
    taken = {c.lower() for c in df.columns}
    name = wanted
    while name.lower() in taken:
        name = f"_{name}"
    return name


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Let Python workers import this library even where it is not installed on them."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        library = Path(__file__).resolve().parents[1]
        archive = shutil.make_archive(
            f"{tempfile.mkdtemp(prefix='feedworks-code-')}/{library.name}", "zip", library.parent, library.name
        )
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def shipped(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """``query`` (which gets the session first), with the code shipped before it runs."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args) -> DataFrame:
        ship_code(spark)
        return query(spark, *args)

    return run
