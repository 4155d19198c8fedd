"""Column builders that turn raw feed text into typed values.

Every builder is total: text it cannot read becomes null, never an error, so one
bad cell cannot stop a job. All of them are built-in expressions and stay inside
whole-stage codegen.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the feed contract.
NULL_TOKENS = ("", "NULL", "null", "None", "N/A", "n/a")
MONEY_TYPE = "decimal(12,2)"
UNPARSEABLE = "unparseable_row"
MISSING_PREFIX = "missing_required_field:"

WHOLE_NUMBER = r"^[\s\p{Cntrl}]*[+-]?[0-9]+[\s\p{Cntrl}]*$"


def text_or_null(text: Column) -> Column:
    """Text without surrounding spaces; null when it spells "no value"."""
    value = F.trim(text)
    return F.when(~value.isin(*NULL_TOKENS), value)


def parse_date(text: Column, pattern: str) -> Column:
    return _if_possible(text, pattern, F.try_to_date(text, pattern))


def parse_timestamp(text: Column, pattern: str) -> Column:
    return _if_possible(text, pattern, F.try_to_timestamp(text, F.lit(pattern)))


def _if_possible(text: Column, pattern: str, parsed: Column) -> Column:
    """``parsed`` where text can be a time written like ``pattern``: failing ones are dear, as with ints.

    A number in the pattern needs a digit, any other letter more than spaces; parts in
    brackets may be left out and so need nothing.
    """
    required = re.sub(r"\[.*\]|'[^']*'", "", pattern, flags=re.DOTALL)
    if re.search(r"[ydDHhKkmsS]", required):
        return F.when(text.rlike("[0-9]"), parsed)
    return F.when(text.rlike(r"\S"), parsed) if re.search("[A-Za-z]", required) else parsed


def parse_int(text: Column) -> Column:
    """Whole number. The pattern lets through all that the cast accepts.

    Words in place of numbers are common, and a failing cast costs some twenty
    times a good one because it raises inside, so they are sorted out before.
    """
    return F.when(text.rlike(WHOLE_NUMBER), text.try_cast("int"))


def parse_money(text: Column) -> Column:
    """Amount with any ``$`` and thousands commas taken out.

    ``replace`` hands back text without a match as it is, which most amounts are;
    ``translate`` and patterns build it anew. Text without a digit is not tried.
    """
    number = F.trim(text)
    for sign in ("$", ","):
        number = F.replace(number, F.lit(sign), F.lit(""))
    # Asked of the text itself: the number would be built twice, to be tested and to be read.
    return F.when(text.rlike(r"\p{Nd}"), number.try_cast(MONEY_TYPE))


def parse_flag(text: Column, true_values: Sequence[str], false_values: Sequence[str]) -> Column:
    """Boolean by membership in the feed's own spellings; null for any other text."""
    value = F.trim(text)
    return F.when(value.isin(*true_values), True).when(value.isin(*false_values), False)


def is_rejected(corrupt: Column, required: Mapping[str, Column]) -> Column:
    """Two-valued test: the line did not parse, or a required value is missing."""
    bad = corrupt.isNotNull()
    for value in required.values():
        bad = bad | value.isNull()
    return bad


def rejection_reason(corrupt: Column, required: Mapping[str, Column]) -> Column:
    """Why a row is set aside, naming all missing fields; null for a good row."""
    missing = F.concat_ws(",", *[F.when(v.isNull(), F.lit(n)) for n, v in required.items()])
    return F.when(corrupt.isNotNull(), F.lit(UNPARSEABLE)).when(
        is_rejected(corrupt, required), F.concat(F.lit(MISSING_PREFIX), missing)
    )


def surrogate_key(*parts: str) -> Column:
    """Parts joined by ``_``; null parts are left out."""
    return F.concat_ws("_", *parts)
