"""Normal form of uris."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Around the uri and before its path: blanks, brackets, quotes, scheme, slashes, "www."; the path ends at a query, fragment or closing sign.
_PATH = r"(?U)^[\s<\"']*(?:[a-z][a-z0-9+.\-]*:(?!\d))?/*(?:www\.)?([^?#\s<>\"']*)"


# A uri that is in normal form but for its scheme; most are, and need one look only.
_NORMAL = r"^https?://(?!www\.)[a-z0-9.\-]++(?:/[a-z0-9._~\-]++)++\z"


def uri_form(uri: Column) -> Column:
    """A uri without the spellings that do not change what it names: blanks and brackets around
    it, scheme, "www.", letter case, doubled and trailing slashes, query, fragment and
    percent-encoded letters. Empty when nothing is left; null for null. Every step uses the one
    before it once, so the expression stays small wherever the optimizer copies it."""
    u = F.regexp_extract(F.lower(uri), _PATH, 1)
    u = F.regexp_replace(F.replace(u, F.lit("+"), F.lit("%2b")), "%(?![0-9a-f]{2})", "%25")
    u = F.regexp_replace(F.lower(F.url_decode(u)), "/{2,}", "/")
    u = F.rtrim(F.regexp_replace(u, r":(?:80|443)(?=/|$)", ""), F.lit("/"))
    return F.when(uri.rlike(_NORMAL), F.substring_index(uri, "://", -1)).otherwise(u)


def uri_key(uri: Column) -> Column:
    """uri_form, null when nothing is left."""
    return F.nullif(uri_form(uri), F.lit(""))
