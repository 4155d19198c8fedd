"""Raw rows to typed rows, good ones apart from rejected ones."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from feedworks.functions import values
from feedworks.functions.transforms import TRANSFORM_OUTPUTS, TRANSFORMS
from feedworks.sources.spec import CORRUPT_COLUMN, PATH_COLUMN, SYSTEM_COLUMNS, FeedSpec
from feedworks.sources.tables import quoted_column

REASON_COLUMN = "_quarantine_reason"
RAW_COLUMN = "_raw"
REJECTED_COLUMN = "_rejected"


class _Projection:
    """The columns of one ``select``, built up step by step.

    Setting a name that is already there replaces that column in place. Reading a
    name gives its current expression, so a step sees what earlier steps made of a
    column although everything ends up in a single select.
    """

    def __init__(self, df: DataFrame):
        self._df = df
        exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
        self.fold = (lambda name: name) if exact else str.lower
        self._columns = {self.fold(name): (name, F.col(quoted_column(name))) for name in df.columns}

    def __getitem__(self, name: str) -> Column:
        known = self._columns.get(self.fold(name))
        return F.col(quoted_column(name)) if known is None else known[1]

    def __setitem__(self, name: str, value: Column) -> None:
        self._columns[self.fold(name)] = (name, value)

    def pop(self, name: str) -> Column:
        return self._columns.pop(self.fold(name))[1]

    def select(self) -> DataFrame:
        return self._df.select(*[value.alias(name) for name, value in self._columns.values()])


def tag_rows(raw_rows: DataFrame, cfg: FeedSpec | Mapping[str, Any]) -> DataFrame:
    """Every raw row, typed, with the reason it is rejected (null if it is not).

    The last columns are ``_raw``, ``_quarantine_reason`` and ``_rejected``. ``_raw``
    has the feed's own text, on rejected rows only, of the columns whose typed form
    takes their place; a feed without such columns has no ``_raw``.
    """
    spec = FeedSpec.of(cfg)
    out = _Projection(raw_rows)
    replaced = [F.col(quoted_column(c)) for c in _replaced_columns(raw_rows, spec, out.fold)]
    raw = F.struct(*replaced) if replaced else None

    out["client_id"] = out["_client_id"]
    for source, target in spec.column_map.items():
        out[target] = values.text_or_null(out[source])
    if spec.special_transform is not None:
        if raw is not None:
            out[RAW_COLUMN] = raw
        out = _Projection(TRANSFORMS[spec.special_transform](out.select()))
        raw = None if raw is None else out.pop(RAW_COLUMN)
    for source, date in spec.date_fields.items():
        parse = values.parse_date if date.type == "date" else values.parse_timestamp
        out[date.target] = parse(out[source], date.format)
    for source, target in spec.int_fields.items():
        out[target] = values.parse_int(out[source])
    for source, target in spec.decimal_fields.items():
        out[target] = values.parse_money(out[source])
    for source, flag in spec.boolean_fields.items():
        out[flag.target] = values.parse_flag(out[source], flag.true_values, flag.false_values)
    if spec.default_currency is not None:
        out["currency"] = F.lit(spec.default_currency)
    out["_silver_refined_ts"] = F.current_timestamp()

    corrupt = out[CORRUPT_COLUMN]
    required = {name: out[name] for name in spec.required_fields}
    rejected = values.is_rejected(corrupt, required)
    if raw is not None:
        out[RAW_COLUMN] = F.when(rejected, raw)
    out[REASON_COLUMN] = values.rejection_reason(corrupt, required)
    out[REJECTED_COLUMN] = rejected
    return out.select()


def _replaced_columns(raw_rows: DataFrame, spec: FeedSpec, fold: Callable[[str], str]) -> list[str]:
    """Feed columns that a step overwrites; all of them if a transform's outputs are unknown."""
    columns = [c for c in raw_rows.columns if c not in (*SYSTEM_COLUMNS, PATH_COLUMN)]
    outputs = TRANSFORM_OUTPUTS.get(spec.special_transform, columns if spec.special_transform else ())
    targets = {fold(t) for t in ("client_id", *spec.targets(), *outputs)}
    return [c for c in columns if fold(c) in targets]


def clean_columns(tagged: DataFrame) -> list[str]:
    return [c for c in tagged.columns if c not in (RAW_COLUMN, REASON_COLUMN, REJECTED_COLUMN)]


def quarantine_columns(tagged: DataFrame) -> list[str]:
    return [c for c in tagged.columns if c != REJECTED_COLUMN]


def refine_entity(bronze_df: DataFrame, entity_cfg: FeedSpec | Mapping[str, Any]) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows): together every raw row, none in both.

    Each of the two frames types the required fields twice, to filter and to show them; the
    refine stage writes ``tag_rows`` once instead.
    """
    tagged = tag_rows(bronze_df, entity_cfg)
    clean = tagged.filter(~F.col(REJECTED_COLUMN)).select(*map(quoted_column, clean_columns(tagged)))
    quarantine = tagged.filter(REJECTED_COLUMN).select(*map(quoted_column, quarantine_columns(tagged)))
    return clean, quarantine
