"""Named row transforms a feed spec can ask for with ``special_transform``.

A transform takes a DataFrame and returns one. It runs after the renames and
before the typed fields, for the few things a rename table cannot say.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Transform = Callable[[DataFrame], DataFrame]


def split_full_name(df: DataFrame) -> DataFrame:
    """``full_name`` to ``first_name`` and ``last_name`` at the first whitespace run.

    A single word is a first name only; blank text gives two nulls.
    """
    name = F.nullif(F.trim(F.col("full_name")), F.lit(""))
    words = F.split(name, r"\s+", 2)
    return df.withColumns({"first_name": F.get(words, F.lit(0)), "last_name": F.get(words, F.lit(1))})


TRANSFORMS: dict[str, Transform] = {"split_full_name": split_full_name}

# Columns each built-in transform adds, so a spec can be checked before any job.
TRANSFORM_OUTPUTS: dict[str, tuple[str, ...]] = {"split_full_name": ("first_name", "last_name")}


def register_transform(name: str, transform: Transform, outputs: tuple[str, ...] | None = None) -> None:
    """Make ``transform`` available to feed specs; ``outputs`` names the columns it adds."""
    TRANSFORMS[name] = transform
    if outputs is None:
        TRANSFORM_OUTPUTS.pop(name, None)
    else:
        TRANSFORM_OUTPUTS[name] = tuple(outputs)
