"""Raw scan of delimited text: every column a string, bad lines kept and marked."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from feedworks.sources.spec import CORRUPT_COLUMN, PATH_COLUMN, FeedSpec


def raw_schema(columns: Sequence[str]) -> StructType:
    """All-string schema in file order, with the column that holds bad lines last."""
    return StructType([StructField(name, StringType(), True) for name in (*columns, CORRUPT_COLUMN)])


def feed_path(input_dir: str, client_id: str, spec: FeedSpec) -> str:
    return f"{input_dir}/{client_id}/{spec.file}"


#: Endings of compressed files that are read from their start only, so by one task each.
UNSPLITTABLE = (".gz", ".zst", ".deflate", ".snappy", ".lz4")


def is_unsplittable(file: str) -> bool:
    return file.lower().endswith(UNSPLITTABLE)


def read_lines(spark: SparkSession, path: str, header: bool) -> DataFrame:
    """The lines (value) of delimited files as they are, without header and blank lines.

    A compressed file that cannot be split is unpacked by one task; its lines are then dealt out in
    parts of the size that the session advises, so that whatever reads them can use every core.
    """
    # One column whose separator no feed has; should a line have it all the same, the line is kept as a corrupt one.
    lines = (
        spark.read.schema(raw_schema(["line"]))
        .options(sep="\u0001", quote="", header=header, multiLine=False, mode="PERMISSIVE", columnPruning=False)
        .option("columnNameOfCorruptRecord", CORRUPT_COLUMN)
        .csv(path)
    )
    return lines.select(F.coalesce(CORRUPT_COLUMN, "line").alias("value")).hint("rebalance")


def read_raw(
    spark: SparkSession,
    client_id: str,
    entity_name: str,
    entity_cfg: FeedSpec | Mapping[str, Any],
    input_dir: str,
    source_path: bool = False,
    lines_at: str | None = None,
) -> DataFrame:
    """One feed as landed, plus where each row came from.

    A line with the wrong number of fields never fails the read: its whole text is
    kept in the corrupt column. One record is one line, so a large file is read by
    many tasks. ``file`` may be a directory or glob; with a header, every file in
    it starts with one. ``source_path`` adds the file that each row really came from,
    which a directory or glob does not tell. ``lines_at`` is where ``read_lines`` of the feed
    were written, to be read instead.
    """
    spec = FeedSpec.of(entity_cfg)
    scan = (
        spark.read.schema(raw_schema(spec.columns))
        .options(
            sep=spec.delimiter,
            header=spec.header and lines_at is None,
            quote=spec.quote,
            escape='"',
            multiLine=False,
            mode="PERMISSIVE",
            columnNameOfCorruptRecord=CORRUPT_COLUMN,
            enforceSchema=not spec.validate_header,
            # With pruning on, a query of few columns parses only those and no
            # longer notices that a line has too few or too many fields.
            columnPruning=False,
        )
        .csv(feed_path(input_dir, client_id, spec) if lines_at is None else lines_at)
    )
    lineage = {
        "_client_id": F.lit(client_id),
        "_entity": F.lit(entity_name),
        "_source_file": F.lit(spec.file),
        "_ingestion_ts": F.current_timestamp(),
    }
    if source_path:
        lineage[PATH_COLUMN] = F.col("_metadata.file_path")
    return scan.withColumns(lineage)
