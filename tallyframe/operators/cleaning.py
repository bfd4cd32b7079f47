"""Rule-driven cleaning: one narrow select per table, fitted caps handed in."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from tallyframe.functions import columns as fx
from tallyframe.operators.order import quantile_table

Bound = tuple[float | None, float | None]


@dataclass(frozen=True)
class CleanRules:
    """What happens to which column. A column absent from the table is skipped.

    Text rules (digits, strip, sentinel, duration) leave non-text columns as they are.
    """

    drop: Sequence[str] = ()
    digits: Sequence[str] = ()
    strip: Mapping[str, str] = field(default_factory=dict)
    number_sentinels: Mapping[str, str] = field(default_factory=dict)
    durations: Sequence[str] = ()
    text_sentinels: Mapping[str, str] = field(default_factory=dict)
    valid_ranges: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    bounds: Mapping[str, Bound] = field(default_factory=dict)
    quantile_caps: Mapping[str, float] = field(default_factory=dict)
    label: str | None = None
    label_codes: Mapping[str, int] = field(default_factory=dict)


def _cleaned(name: str, text: bool, rules: CleanRules, caps: Mapping[str, float]) -> Column:
    c: Column = F.col(name)
    number = not text
    if text and name in rules.digits:
        c, number = fx.digits_only(c), True
    elif text and name in rules.strip:
        c, number = fx.without_char(c, rules.strip[name]), True
    elif text and name in rules.number_sentinels:
        c, number = fx.text_to_number(fx.sentinel_null(c, rules.number_sentinels[name])), True
    elif text and name in rules.durations:
        c, number = fx.duration_months(c), True
    elif text and name in rules.text_sentinels:
        c = fx.sentinel_null(c, rules.text_sentinels[name])
    if number:
        if name in rules.valid_ranges:
            c = fx.null_outside(c, *rules.valid_ranges[name])
        if name in rules.bounds:
            c = fx.clip(c, *rules.bounds[name])
        if name in caps:
            c = fx.clip(c, hi=caps[name])
    if name == rules.label and text:
        c = fx.map_label(c, rules.label_codes)
    return c.alias(name)


def clean(df: DataFrame, rules: CleanRules, caps: Mapping[str, float] | None = None) -> DataFrame:
    """Apply the rules; ``caps`` are the fitted upper caps, none when absent."""
    return df.select(*[
        _cleaned(f.name, isinstance(f.dataType, T.StringType), rules, caps or {})
        for f in df.schema if f.name not in rules.drop
    ])


def fit_caps(train: DataFrame, rules: CleanRules, rows: int | None = None) -> dict[str, float]:
    """Upper caps from cleaned training rows, before any cap is applied."""
    wanted = {c: q for c, q in rules.quantile_caps.items() if c in train.columns}
    if not wanted:
        return {}
    levels = sorted(set(wanted.values()))
    found = quantile_table(clean(train.select(*wanted), rules), list(wanted), levels, rows=rows)
    return {c: v[levels.index(wanted[c])] for c, v in found.items()}


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*[c for c in columns if c in df.columns])


def encode_label(df: DataFrame, column: str, codes: Mapping[str, int]) -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, fx.map_label(column, codes))
