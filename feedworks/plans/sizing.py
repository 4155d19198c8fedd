"""Session settings that follow the size of the input.

The library sets none itself: partition counts belong to the session. These are
the ones worth setting before a large run.
"""

from __future__ import annotations

from math import ceil

MIB = 1 << 20
GIB = 1 << 30


def session_settings(
    input_bytes: int,
    cores: int,
    partition_bytes: int = 256 * MIB,
    scan_bytes: int = 256 * MIB,
    parallelism_first: bool = False,
) -> dict[str, str]:
    """Spark settings for a run over ``input_bytes`` of raw text on ``cores`` cores.

    Shuffle partitions are as many as it takes for ``partition_bytes`` each, and at least
    one per core; adaptive execution merges those that turn out smaller, but cannot split
    the partitions of a window. So they follow the input at every size: who wants
    fewer asks for larger ones. ``scan_bytes`` is what one scan task reads; each writes a
    file per verdict in refine. ``parallelism_first`` keeps small partitions apart to use
    all cores, which suits inputs of few partitions per core.
    """
    return {
        "spark.sql.files.maxPartitionBytes": str(scan_bytes),
        "spark.sql.shuffle.partitions": str(max(cores, ceil(input_bytes / partition_bytes))),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": str(parallelism_first).lower(),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
    }
