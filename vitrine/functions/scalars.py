"""Scalar functions of the storefront feeds, as native expressions that never raise under ANSI."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Accepted release-date layouts, tried in this order.
RELEASE_DATE_LAYOUTS = ("MMM d, yyyy", "d MMM, yyyy", "yyyy-M-d")
#: Feed language names that differ from the stored ones.
LANGUAGE_ALIASES = {"koreana": "korean"}


def release_date(text: Column) -> Column:
    """Date by the first layout that fits, else null."""
    trimmed = F.trim(text)
    return F.coalesce(*[F.try_to_date(trimmed, layout) for layout in RELEASE_DATE_LAYOUTS])


def safe_int(text: Column) -> Column:
    """Integer, or null for anything else (surrounding blanks are allowed)."""
    return text.try_cast("int")


def normalize_language(language: Column) -> Column:
    """Whole-value mapping; other values stay."""
    out = language
    for alias, name in LANGUAGE_ALIASES.items():
        out = F.when(language == alias, F.lit(name)).otherwise(out)
    return out


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def iso_timestamp(text: Column, default: Column | None = None) -> Column:
    """ISO-8601 instant; unparsable or missing gives ``default`` (now, if not given)."""
    return F.coalesce(F.try_to_timestamp(text), F.current_timestamp() if default is None else default)


def day_of(ts: Column) -> Column:
    return F.to_date(ts)


def first_or_null(array: Column) -> Column:
    return F.get(array, F.lit(0))


def joined_names(names: Column) -> Column:
    """``", "``-joined; a missing list gives the empty string."""
    return F.array_join(F.coalesce(names, F.array().cast("array<string>")), ", ")
