"""Label maps: selectors, canonical text and exposition numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def select_labels(labels: Column, equal: dict[str, str] | None = None,
                  match: dict[str, str] | None = None) -> Column:
    """Conjunction of equality and fully anchored regex selectors.

    A label that is not there reads as '', as in the usual selector rules.
    """
    cond = F.lit(True)
    for name, value in (equal or {}).items():
        cond = cond & (F.coalesce(labels[name], F.lit("")) == value)
    for name, pattern in (match or {}).items():
        cond = cond & F.coalesce(labels[name], F.lit("")).rlike(f"^(?:{pattern})$")
    return cond


def label_columns(labels: Column, names: list[str]) -> list[Column]:
    """Labels as non-null key columns, ready to group or partition by."""
    return [F.coalesce(labels[n], F.lit("")).alias(n) for n in names]


def escape_label(value: Column) -> Column:
    """Backslash, newline and quote escaped as exposition text wants them."""
    v = F.replace(value, F.lit("\\"), F.lit("\\\\"))
    v = F.replace(v, F.lit("\n"), F.lit("\\n"))
    return F.replace(v, F.lit('"'), F.lit('\\"'))


def label_text(labels: Column) -> Column:
    """``{a="1",b="2"}`` with names in order; '' for an empty map."""
    pairs = F.transform(
        F.array_sort(F.map_entries(labels)),
        lambda e: F.concat(e["key"], F.lit('="'), escape_label(e["value"]), F.lit('"')),
    )
    return F.when(F.size(labels) > 0, F.concat(F.lit("{"), F.array_join(pairs, ","), F.lit("}"))) \
        .otherwise(F.lit(""))


def number_text(value: Column) -> Column:
    """A sample value as exposition text: ``65.0``, ``1.5e+06``, ``5e-05``, ``+Inf``, ``NaN``."""
    plain = value.cast("string")
    whole = F.split_part(plain, F.lit("."), F.lit(1))
    fraction = F.split_part(plain, F.lit("."), F.lit(2))
    head = F.regexp_replace(F.split_part(plain, F.lit("E"), F.lit(1)), r"\.0$", "")
    power = F.split_part(plain, F.lit("E"), F.lit(2))
    # Seven integer digits or more switch to an exponent.
    shifted = F.regexp_replace(
        F.concat(F.substring(whole, 1, 1), F.lit("."), F.substring(whole, 2, 400), fraction),
        r"[0.]+$", "")
    return (
        F.when(F.isnan(value), "NaN")
        .when(value == float("inf"), "+Inf")
        .when(value == float("-inf"), "-Inf")
        .when(value >= 1e16, F.concat(head, F.lit("e+"), power))
        .when(value >= 1e7, F.concat(head, F.lit("e+0"), power))
        .when(value >= 1e6, F.concat(shifted, F.lit("e+06")))
        .when((value > 0) & (value < 1e-4), F.concat(head, F.lit("e-"),
                                                     F.lpad(F.substring(power, 2, 3), 2, "0")))
        .when((value > 0) & (value < 1e-3), F.concat(F.lit("0.000"), F.replace(
            head, F.lit("."), F.lit(""))))
        .otherwise(plain)
    )
