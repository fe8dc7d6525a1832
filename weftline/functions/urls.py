"""Relative references, resolved against the address of the page that they stand in, as expressions and in Python.

A reference with a scheme stands for itself; one that begins with // takes the scheme, with / the host, with ? the path,
with # the path and the query; any other is put in place of what follows the last / of the base's path. Segments of one
dot go, and those of two take the one before along.
"""

from __future__ import annotations

from urllib.parse import urljoin

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"


def resolved(base: str, reference: str) -> str:
    """The standard library's resolution, for single values."""
    return urljoin(base, reference)


def _part(url: Column, k: int) -> Column:
    return F.regexp_extract(url, _PARTS, k)


def undotted(path: Column) -> Column:
    """A path without segments of dots. What begins with a slash keeps it, and what ends in dots ends in a slash."""
    segments = F.split(F.regexp_replace(path, "^/", ""), "/")
    pop = lambda kept: F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda s, x: F.when(x == ".", s).when(x == "..", pop(s)).otherwise(F.array_append(s, x)))
    ends = F.when(path.rlike(r"(^|/)\.{1,2}$") & (F.size(kept) > 0), "/").otherwise("")
    return F.concat(F.when(path.startswith("/"), "/").otherwise(""), F.array_join(kept, "/"), ends)


def resolve(base: Column, reference: Column) -> Column:
    """The address that a reference means on a page."""
    scheme, host, path, query, fragment = (_part(reference, k) for k in range(1, 6))
    has = lambda pattern: reference.rlike(pattern)
    tail = F.concat(F.when(has(r"^[^#]*\?"), F.concat(F.lit("?"), query)).otherwise(""), F.when(has("#"), F.concat(F.lit("#"), fragment)).otherwise(""))
    base_path, base_query = _part(base, 3), F.when(base.rlike(r"^[^#]*\?"), F.concat(F.lit("?"), _part(base, 4))).otherwise("")
    origin = F.concat(_part(base, 1), F.lit("://"), _part(base, 2))
    merged = F.concat(F.when(base_path == "", "/").otherwise(F.regexp_replace(base_path, "[^/]*$", "")), path)
    own = F.when(reference.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.concat(scheme, F.lit("://"), host, undotted(path), tail)).otherwise(reference)
    return (
        F.when(has(r"^[A-Za-z][A-Za-z0-9+.-]*:"), own)
        .when(has("^//"), F.concat(_part(base, 1), F.lit("://"), host, undotted(path), tail))
        .when(path != "", F.concat(origin, undotted(F.when(path.startswith("/"), path).otherwise(merged)), tail))
        .when(has(r"^\?"), F.concat(origin, base_path, tail))
        .otherwise(F.concat(origin, base_path, base_query, F.when(has("#"), F.concat(F.lit("#"), fragment)).otherwise("")))
    )


def identity(url: Column) -> Column:
    """What makes two addresses the same page: the host without www. in small letters and the decoded path without its last
    slash; scheme, query and fragment don't count."""
    host = F.regexp_replace(F.lower(_part(url, 2)), r"^www\.", "")
    path = F.url_decode(F.replace(_part(url, 3), F.lit("+"), F.lit("%2B")))
    return F.concat(host, F.regexp_replace(path, "/$", ""))
