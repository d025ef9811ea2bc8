"""Address functions as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Python strips leading blanks and control characters, and drops tabs and line breaks inside.
_LEADING, _INSIDE = r"^[\x00-\x20]+", r"[\t\r\n]"
#: The host whose addresses come with doubled path separators.
DOUBLED_HOST = "strategypage.com"


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, _LEADING, ""), _INSIDE, "")


def part(url: Column, which: str) -> Column:
    """scheme, authority, path or query of an address ('' where it has none)."""
    group = {"scheme": 1, "authority": 2, "path": 3, "query": 4}[which]
    return F.regexp_extract(_clean(url), r"^(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?", group)


def domain(url: Column) -> Column:
    """Lower-case authority, with port and user if given."""
    return F.lower(part(url, "authority"))


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_extract(part(url, "authority"), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def admitted(url: Column) -> Column:
    """Whether an address can be fetched: http or https, with a host."""
    return F.coalesce(F.lower(part(url, "scheme")).isin("http", "https") & (host(url) != ""), F.lit(False))


def normalized(url: Column) -> Column:
    """Lower-case scheme and authority, no fragment, backslashes as slashes.

    Query, tracking parameters and encoded bytes stay.  Only where backslashes were found on the
    host known for it are runs of slashes in the path made one.
    """
    slashed = url.rlike(r"(?i)%5c|\\")
    url = F.regexp_replace(url, r"(?i)%5c|\\", "/")
    scheme, authority, path, query = (part(url, x) for x in ("scheme", "authority", "path", "query"))
    path = F.when(slashed & host(url).endswith(DOUBLED_HOST), F.regexp_replace(path, "/+", "/")).otherwise(path)
    return F.concat(F.when(scheme != "", F.concat(F.lower(scheme), F.lit(":"))).otherwise(""), F.when(authority != "", F.concat(F.lit("//"), F.lower(authority))).otherwise(""), path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))


def falls_to_home(asked: Column, final: Column) -> Column:
    """Whether an address with several path segments ended at an empty path."""
    steps = F.size(F.split(F.regexp_replace(part(asked, "path"), "^/+|/+$", ""), "/"))
    return (steps > 1) & (F.regexp_replace(part(final, "path"), "^/+|/+$", "") == "")
