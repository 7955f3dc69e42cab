"""What may be shown of a media URL, and which hosts may be fetched."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Literal hosts on this machine or in private, link-local and reserved IPv4 or IPv6 ranges.
PRIVATE = (
    r"(?i)^(localhost|.*\.localhost|.*\.local|0\..*|10\..*|127\..*|169\.254\..*|192\.168\..*|172\.(1[6-9]|2\d|3[01])\..*"
    r"|100\.(6[4-9]|[789]\d|1[01]\d|12[0-7])\..*|\[?(::1?|f[cd][0-9a-f]{2}:.*|fe[89ab][0-9a-f]:.*)\]?)$"
)
SIZE_LIMIT = 4 * 1024**3


def redacted(url: Column) -> Column:
    """Scheme, host, port and path: no user, query or fragment."""
    return F.regexp_replace(url, r"^([A-Za-z][A-Za-z0-9+.-]*://)(?:[^/?#@]*@)?([^?#]*).*$", "$1$2")


def query_redacted(url: Column) -> Column:
    return F.regexp_like(url, F.lit(r"^[^#?]*\?[^#]"))


def host(url: Column) -> Column:
    """Host without user and port, lower-cased; null without a scheme."""
    found = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]]*\]|[^/?#:]*)", 1)
    return F.lower(F.when(found == "", None).otherwise(found))


def is_private(url: Column) -> Column:
    return F.coalesce(host(url).rlike(PRIVATE), F.lit(True))


def fingerprint(content: Column) -> Column:
    return F.sha2(content.cast("binary"), 256)


def checked(url: Column, allow_private_hosts: bool = False) -> Column:
    """The URL; a private host fails the query unless allowed."""
    if allow_private_hosts:
        return url
    return F.when(is_private(url), F.raise_error(F.concat(F.lit("private or missing host: "), redacted(url)))).otherwise(url)
