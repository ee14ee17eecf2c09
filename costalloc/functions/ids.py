"""Identifier clean-up."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The stand-in for a missing id, and texts that mean "missing".
UNKNOWN = "unknown"
MISSING_TEXTS = ["", "null", "None"]


def non_empty(c: Column) -> Column:
    """NULL for an empty text, so that coalesce() can move on to the next source."""
    return F.nullif(c, F.lit(""))


def known_or_unknown(c: Column) -> Column:
    return F.when(c.isNull() | c.isin(MISSING_TEXTS), UNKNOWN).otherwise(c)


def url_host_label(url: Column) -> Column:
    """First label of the host of a URL; '' where there is no host."""
    return F.regexp_extract(url, r"^http[^:/?#]*://(?:[^/?#@]*@)?([^/?#:.]*)", 1)


def normalize_resource_id(c: Column) -> Column:
    """One short name for a resource, whether it came as a path, a URL or a name.

    Never NULL, so joins on it need no extra null check on every input row.
    """
    text = F.lower(F.btrim(c, F.lit(" \t\r\n")))
    short = (
        F.when((c == "") | (c == UNKNOWN), UNKNOWN)
        .when(text.startswith("/subscriptions/"), F.substring_index(text, "/", -1))
        .when(text.startswith("http"), non_empty(url_host_label(text)))
        .otherwise(text)
    )
    return F.coalesce(short, F.lit(UNKNOWN))


def path_part_after(path: Column, marker: str) -> Column:
    """The path segment that follows `marker`, ignoring case; '' if absent."""
    return F.regexp_extract(path, rf"(?i)(?:^|/){marker}/([^/]*)", 1)


def last_path_part(path: Column) -> Column:
    return F.coalesce(F.substring_index(path, "/", -1), F.lit(""))
