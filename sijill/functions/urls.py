"""URL expressions. Parts come from one pattern, since parse_url rejects spaces under ANSI mode."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import let, strip

#: scheme, authority, path, query of a reference; the fragment is left out.
PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(\?[^#]*)?"
#: Fixed value: the slug of a URL without path segments.
NO_SLUG = "نسخة"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, PARTS, group)


def unescape_path(path: Column) -> Column:
    """Percent escapes decoded; signs that are no escape and plus stay."""
    bare = F.regexp_replace(F.regexp_replace(path, "%(?![0-9A-Fa-f]{2})", "%25"), r"\+", "%2B")
    return F.when(F.contains(path, F.lit("%")), F.coalesce(F.try_url_decode(bare), path)).otherwise(path)


def host(url: Column) -> Column:
    """Lower-case host without user and port."""
    return F.lower(F.regexp_replace(F.regexp_replace(_part(strip(url), 2), "^[^@]*@", ""), r":\d*$", ""))


def authority(url: Column) -> Column:
    """Host as written, with user and port."""
    return _part(strip(url), 2)


def canonical_url(url: Column) -> Column:
    """The form under which a document is known: scheme and host in lower case, path decoded, no user, no fragment."""

    def joined(whole: Column) -> Column:
        scheme = F.coalesce(F.nullif(F.lower(_part(whole, 1)), F.lit("")), F.lit("https"))
        port = F.regexp_extract(_part(whole, 2), r"(:0*[1-9]\d*)$", 1)
        query = F.regexp_replace(_part(whole, 4), r"^\?$", "")
        return F.concat(scheme, F.lit("://"), host(whole), F.regexp_replace(port, ":0*", ":"), let(_part(whole, 3), unescape_path), query)

    return let(strip(url), joined)


def slug(url: Column) -> Column:
    """The last non-empty path segment, decoded."""
    last = F.try_element_at(F.filter(F.split(_part(strip(url), 3), "/"), lambda x: x != ""), F.lit(-1))
    return let(last, lambda x: F.coalesce(unescape_path(x), F.lit(NO_SLUG)))


def on_hosts(url: Column, hosts: Sequence[str]) -> Column:
    """Whether the host is one of ``hosts`` or a subdomain."""
    name = host(url)
    return F.exists(F.array(*map(F.lit, hosts)), lambda h: (name == h) | F.endswith(name, F.concat(F.lit("."), h)))
