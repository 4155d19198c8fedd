"""Steps that several later passes read together with something small, kept in buckets.

Rows of one bucket stay together, so a later join or cogroup by the bucketing column shuffles
only its other side.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from feedworks.llm.common import fresh_path


def bucketed(df: DataFrame, name: str, column: str) -> DataFrame:
    """``df`` as a table in the shared folder, in as many buckets of ``column`` as shuffles have partitions.

    Nothing is shuffled to write it: a task writes its own rows of every bucket. The name in
    the catalog goes at once, the files are what the returned frame reads.
    """
    spark = df.sparkSession
    table = f"feedworks_{name.replace('-', '_')}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = df.write.bucketBy(buckets, column).option("path", fresh_path(spark, name)).option("compression", "zstd")
    writer.saveAsTable(table)
    rows = spark.table(table)
    rows.schema  # resolved while the name is there
    spark.sql(f"DROP TABLE {table}")
    return rows
