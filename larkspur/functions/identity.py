"""Deterministic identity of a listing from its address."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalize_url(url: Column) -> Column:
    """Lower-case scheme, host and path; no parameters, query, fragment or closing slashes; null as ''."""
    bare = F.regexp_replace(F.lower(F.coalesce(url, F.lit(""))), r"[;?#][\s\S]*$", "")
    return F.regexp_replace(bare, "/+$", "")


def property_id(url: Column, prefix: str = "") -> Column:
    """Prefix and the first 16 hexadecimal digits of the MD5 of the normalized address; of 'empty' where there is none."""
    bare = normalize_url(url)
    return F.concat(F.lit(prefix), F.substring(F.md5(F.when(bare == "", "empty").otherwise(bare)), 1, 16))


def absolute_url(base: Column, path: Column) -> Column:
    root = F.regexp_extract(base, r"^([a-zA-Z]+://[^/?#]*)", 1)
    folder = F.regexp_replace(F.regexp_replace(base, r"[?#].*$", ""), r"(://[^/]*/?.*?)[^/]*$", "$1")
    return (
        F.when(path.rlike("^[a-zA-Z][a-zA-Z0-9+.-]*://"), path)
        .when(path.startswith("/"), F.concat(root, path))
        .otherwise(F.concat(F.when(folder.rlike("://[^/]+$"), F.concat(folder, F.lit("/"))).otherwise(folder), path))
    )


def page_url(url: Column, page: Column) -> Column:
    return F.when(page <= 1, url).otherwise(F.concat(url, F.when(F.instr(url, "?") > 0, "&page=").otherwise("?page="), page.cast("string")))


def is_hash_id(c: Column) -> Column:
    return F.coalesce(c.rlike("^[0-9a-fA-F]{16}$"), F.lit(False))
