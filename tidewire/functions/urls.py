"""URL expressions: canonical form, allow-lists, safety."""

from __future__ import annotations

import ipaddress

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidewire.functions.profiles import TRACKING_PARAMETERS
from tidewire.functions.text import arrow, each

URL = r"^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#.*)?$"
IP_LITERAL = r"^(?:\d{1,3}(?:\.\d{1,3}){3}|[0-9a-f:.]*:[0-9a-f:.]*)$"


def is_local_address(host: str) -> bool:
    try:
        address = ipaddress.ip_address(host)
    except ValueError:
        return False
    return address.is_private or address.is_loopback or address.is_link_local or address.is_reserved


@arrow(T.BooleanType())
def _local_address(hosts: pa.Array) -> pa.Array:
    return each(hosts, is_local_address, pa.bool_())


def _decoded(c: Column) -> Column:
    return F.try_url_decode(F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25"))


def _encoded(c: Column) -> Column:
    return F.replace(F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def _query(raw: Column) -> Column:
    """Parameters without trackers, re-encoded, in their order."""
    given = F.filter(F.split(raw, "&"), lambda p: p != "")
    decoded = F.transform(
        given,
        lambda p: F.struct(
            _decoded(F.regexp_extract(p, "^[^=]*", 0)).alias("name"),
            _decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("value"),
        ),
    )
    kept = F.filter(
        decoded,
        lambda p: ~F.startswith(F.lower(p["name"]), F.lit("utm_")) & ~F.lower(p["name"]).isin(*TRACKING_PARAMETERS),
    )
    return F.array_join(F.transform(kept, lambda p: F.concat(_encoded(p["name"]), F.lit("="), _encoded(p["value"]))), "&")


def url_parts(c: Column) -> Column:
    """struct<scheme, host, port, path, query, userinfo> of an absolute URL (empty strings when absent)."""
    url = F.regexp_replace(F.trim(F.regexp_replace(c, r"^[\x00-\x20]+", "")), r"[\t\r\n]", "")
    authority = F.regexp_extract(url, URL, 2)
    server = F.regexp_extract(authority, r"([^@]*)$", 1)
    bracketed = F.startswith(server, F.lit("["))
    host = F.when(bracketed, F.regexp_extract(server, r"^\[([^\]]*)\]", 1)).otherwise(
        F.regexp_extract(server, r"^([^:]*)", 1)
    )
    tail = F.when(bracketed, F.regexp_extract(server, r"^\[[^\]]*\](.*)$", 1)).otherwise(
        F.regexp_extract(server, r"^[^:]*(.*)$", 1)
    )
    return F.struct(
        F.lower(F.regexp_extract(url, URL, 1)).alias("scheme"),
        F.regexp_replace(F.lower(host), r"\.+$", "").alias("host"),
        F.regexp_extract(tail, r"^:(.+)$", 1).alias("port"),
        F.regexp_extract(url, URL, 3).alias("path"),
        F.regexp_extract(url, URL, 4).alias("query"),
        F.regexp_extract(authority, r"^(.*)@", 1).alias("userinfo"),
    )


def port_of(u: Column) -> Column:
    return F.when(u["port"].rlike(r"^0*\d{1,5}$"), u["port"].cast("int"))


def is_public(u: Column) -> Column:
    """Whether the parts are those of an absolute public HTTP(S) URL: whether `canonical_url` has a value."""
    host = u["host"]
    local = F.coalesce(_local_address(F.when(host.rlike(IP_LITERAL), host)), F.lit(False))
    port_ok = (u["port"] == "") | u["port"].rlike(r"^0*\d{1,5}$")
    return (
        u["scheme"].isin("http", "https")
        & (host != "")
        & u["userinfo"].isin("", ":")
        & port_ok
        & F.coalesce(port_of(u) <= 65535, F.lit(True))
        & ~local
    )


def canonical_url(c: Column) -> Column:
    """Comparable form of an absolute public HTTP(S) URL, or null when it is not one.

    Lower-case scheme and host, no default port, no tracking parameters, no repeated or trailing slash,
    no fragment; credentials and private, loopback, link-local or reserved addresses are refused.
    """
    u = url_parts(c)
    host = u["host"]
    port = port_of(u)
    shown_port = F.when(
        port.isNull() | (port == 0) | ((u["scheme"] == "http") & (port == 80)) | ((u["scheme"] == "https") & (port == 443)),
        F.lit(""),
    ).otherwise(F.concat(F.lit(":"), port.cast("string")))
    path = F.regexp_replace(F.when(u["path"] == "", F.lit("/")).otherwise(u["path"]), "/{2,}", "/")
    path = F.when(path == "/", path).otherwise(F.regexp_replace(path, "/$", ""))
    query = _query(u["query"])
    shown_query = F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), query))
    return F.when(is_public(u), F.concat(u["scheme"], F.lit("://"), host, shown_port, path, shown_query))


def safe_external_url(c: Column) -> Column:
    """The URL when it is HTTP(S), else null."""
    url = F.trim(c)
    return F.when(url.rlike(r"(?i)^https?://[^/?#]"), url)


def host_allowed(host: Column, allowed: Column, subdomains: bool | Column = True) -> Column:
    within = F.exists(allowed, lambda a: F.endswith(host, F.concat(F.lit("."), a)))
    flag = F.lit(subdomains) if isinstance(subdomains, bool) else subdomains
    return F.array_contains(allowed, host) | (flag & within)


def linked_page_allowed(canonical: Column, hosts: Column, prefixes: Column, exact_host: Column) -> Column:
    """For a canonical URL: HTTPS, an allowed host, an allowed path prefix, and no suffix other than .html/.htm."""
    u = url_parts(canonical)
    suffix = F.lower(F.regexp_extract(u["path"], r"[^/](\.[^./]+)$", 1))
    return F.coalesce(
        (u["scheme"] == "https")
        & host_allowed(u["host"], hosts, ~exact_host)
        & F.exists(prefixes, lambda p: F.startswith(u["path"], p))
        & suffix.isin("", ".html", ".htm"),
        F.lit(False),
    )
