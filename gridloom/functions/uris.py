"""File names and URIs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def decoded_uri(path: Column) -> Column:
    """Percent-decoded path. A plus stays a plus, and so does a percent sign that begins no escape."""
    escaped = F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25")
    return F.coalesce(F.try_url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))), path)


def folder_of(path: str) -> str:
    return path.rstrip("/").rpartition("/")[0]


def base_name(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)


def extension(name: Column) -> Column:
    return F.lower(F.regexp_extract(name, r"[^./](\.[^./]*)$", 1))


def literal_glob(path: str) -> str:
    """``path`` with glob characters escaped, so that a reader takes it literally."""
    return "".join("\\" + ch if ch in "\\*?[]{}" else ch for ch in path)
