"""Scalar expressions.  All of them stay inside generated code; none is a Python UDF."""

from __future__ import annotations

import json
from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def strict_timestamp(text: Column | str) -> Column:
    """Text to timestamp without zone; bad text is an error, null stays null."""
    return _col(text).cast("timestamp_ntz")


def lenient_timestamp(text: Column | str) -> Column:
    """Text to timestamp without zone; bad text becomes null."""
    return _col(text).try_cast("timestamp_ntz")


def floored_days(later: Column | str, earlier: Column | str) -> Column:
    """Whole days from ``earlier`` to ``later``, rounded down: minus twelve hours is -1.

    Subtracting gives an exact interval in microseconds.  Its day field is cut toward zero, so a
    negative rest takes off one more day.  No session time zone is involved for zone-less input.
    """
    span = _col(later) - _col(earlier)
    whole = F.extract(F.lit("DAY"), span)
    return (
        whole - F.when(span < F.make_dt_interval(whole), F.lit(1)).otherwise(F.lit(0))
    ).cast("bigint")


def year_month(moment: Column | str) -> Column:
    return F.date_format(_col(moment), "yyyy-MM")


def trimmed(text: Column | str) -> Column:
    """Strip blanks, tabs and line breaks on both sides."""
    return F.regexp_replace(_col(text), r"^\s+|\s+$", "")


def clean_city(text: Column | str) -> Column:
    return F.coalesce(trimmed(F.lower(_col(text))), F.lit("desconocido"))


def clean_state(text: Column | str) -> Column:
    return F.coalesce(trimmed(F.upper(_col(text))), F.lit("DESCONOCIDO"))


def lenient_number(text: Column | str) -> Column:
    """Text to double; text that is no number becomes null."""
    return _col(text).try_cast("double")


def late_flag(delay: Column | str) -> Column:
    """1 when the delay is positive, else 0; an unknown delay counts as 0."""
    return F.coalesce(_col(delay) > 0, F.lit(False)).cast("int")


def repeat_flag(orders: Column | str) -> Column:
    """1 when a customer has more than one order."""
    return (_col(orders) > 1).cast("int")


def item_value(price: Column | str, shipping: Column | str) -> Column:
    return _col(price) + _col(shipping)


def half_even(value: Column | str, digits: int) -> Column:
    return F.bround(_col(value), digits)


def mean_pm_std(mean: Column | str, std: Column | str) -> Column:
    """Text such as ``0.8412 ± 0.0203``."""
    return F.format_string("%.4f ± %.4f", half_even(mean, 4), half_even(std, 4))


def relative_gap(first: Column | str, second: Column | str) -> Column:
    """|second - first| relative to |first|, null when the first is zero."""
    first, second = _col(first), _col(second)
    return F.when(
        first != 0, F.abs(second - first) / (F.abs(first) + F.lit(1e-12))
    )


def absolute_gap(first: Column | str, second: Column | str) -> Column:
    return F.abs(_col(second) - _col(first))


def params_text(params: Mapping[str, Any]) -> str:
    """Settings of a model as compact JSON text with sorted keys."""
    return json.dumps(dict(params), sort_keys=True, default=str, separators=(",", ":"))


def params_column(params: Mapping[str, Column | str]) -> Column:
    """The same text from columns, for settings that are computed by Spark."""
    return F.to_json(F.struct(*[_col(params[name]).alias(name) for name in sorted(params)]))
