"""Fetching a media file over HTTP(S): a step of the driver before any query."""

from __future__ import annotations

import hashlib
import ipaddress
import json
import socket
import urllib.request
from pathlib import Path
from urllib.parse import unquote, urlsplit, urlunsplit

LIMIT = 4 * 1024**3


def display_url(url: str) -> str:
    """The URL without user, query and fragment."""
    u = urlsplit(url)
    return urlunsplit((u.scheme, u.netloc.rpartition("@")[2], u.path, "", ""))


def validate_url(url: str, allow_private_hosts: bool = False) -> str:
    """The URL, or the program ends: only HTTP and HTTPS, and no host that resolves to a private address."""
    u = urlsplit(url)
    if u.scheme not in ("http", "https") or not u.hostname:
        raise SystemExit(f"not an HTTP(S) URL: {display_url(url)}")
    if not allow_private_hosts:
        try:
            found = {info[4][0] for info in socket.getaddrinfo(u.hostname, u.port or 80, proto=socket.IPPROTO_TCP)}
        except OSError as e:
            raise SystemExit(f"host not found: {u.hostname}") from e
        if any(not ipaddress.ip_address(a.partition("%")[0]).is_global for a in found):
            raise SystemExit(f"private host: {u.hostname}")
    return url


class _Checked(urllib.request.HTTPRedirectHandler):
    def __init__(self, allow_private_hosts: bool):
        self.allow = allow_private_hosts

    def redirect_request(self, req, fp, code, msg, headers, newurl):
        return super().redirect_request(req, fp, code, msg, headers, validate_url(newurl, self.allow))


def download_media(url: str, directory: Path, allow_private_hosts: bool = False, limit: int = LIMIT, overwrite: bool = False) -> dict:
    """Fetches url into directory, following redirects that pass the same check, and writes download.json beside it."""
    validate_url(url, allow_private_hosts)
    opener = urllib.request.build_opener(_Checked(allow_private_hosts))
    with opener.open(url, timeout=60) as answer:
        final = answer.geturl()
        name = Path(unquote(urlsplit(final).path)).name or "media"
        directory = Path(directory)
        directory.mkdir(parents=True, exist_ok=True)
        to = directory / name
        if to.exists() and not overwrite:
            raise SystemExit(f"exists already: {to}")
        part, digest, n = to.with_name(to.name + ".part"), hashlib.sha256(), 0
        with part.open("wb") as out:
            while block := answer.read(1 << 20):
                n += len(block)
                if n > limit:
                    out.close()
                    part.unlink()
                    raise SystemExit(f"larger than {limit} bytes: {display_url(final)}")
                digest.update(block)
                out.write(block)
        part.replace(to)
        kind = answer.headers.get("Content-Type")
    record = {
        "path": str(to),
        "source_url": display_url(url),
        "resolved_url": display_url(final),
        "url_query_redacted": bool(urlsplit(url).query or urlsplit(final).query),
        "bytes": n,
        "content_type": kind,
        "sha256": digest.hexdigest(),
    }
    (directory / "download.json").write_text(json.dumps(record, ensure_ascii=False) + "\n", encoding="utf-8")
    return record
