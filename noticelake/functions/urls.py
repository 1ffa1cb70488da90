"""URL shape predicates over link columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import blank_to_null, let


def scheme(c: Column) -> Column:
    return F.lower(blank_to_null(F.regexp_extract(c, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1)))


def authority(c: Column) -> Column:
    return blank_to_null(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1))


def host(c: Column) -> Column:
    """Lower-case host without credentials and port."""
    return F.lower(blank_to_null(F.regexp_extract(authority(c), r"^(?:[^@]*@)?([^@:]*)(?::\d*)?$", 1)))


def port(c: Column) -> Column:
    return F.regexp_extract(authority(c), r":(\d+)$", 1).try_cast("int")


def path(c: Column) -> Column:
    return F.regexp_extract(c, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query_values(c: Column, key: str) -> Column:
    """Every decoded non-empty value of one query parameter, in order."""
    query = F.regexp_extract(c, r"\?([^#]*)", 1)
    parts = F.filter(F.split(query, "&"), lambda p: p.rlike(f"^{key}=.+"))
    return F.transform(parts, lambda p: decode_form(F.regexp_replace(p, "^[^=]*=", "")))


def repair_escapes(c: Column) -> Column:
    """Turn a percent sign that starts no escape into a literal one."""
    return F.regexp_replace(c, "%(?![0-9A-Fa-f]{2})", "%25")


def decode(c: Column) -> Column:
    """Percent-decoding that keeps plus signs and tolerates broken escapes."""
    return F.coalesce(F.try_url_decode(F.replace(repair_escapes(c), F.lit("+"), F.lit("%2B"))), c)


def decode_form(c: Column) -> Column:
    return F.coalesce(F.try_url_decode(repair_escapes(c)), c)


def has_no_credentials(c: Column) -> Column:
    return ~F.coalesce(authority(c).contains("@"), F.lit(False))


def default_port(c: Column) -> Column:
    text_port = F.regexp_extract(authority(c), r":([^:@]*)$", 1)
    return (text_port == "") | (port(c) == 443)


def is_registered(c: Column, hosts: list[str], blocked_prefixes: tuple[str, ...] = ()) -> Column:
    """HTTPS on a registered host, without credentials, on port 443, off blocked paths."""
    def judge(u: Column) -> Column:
        ok = (scheme(u) == "https") & host(u).isin(hosts) & has_no_credentials(u) & default_port(u)
        for prefix in blocked_prefixes:
            ok = ok & ~F.lower(decode(path(u))).startswith(prefix)
        return ok

    return F.coalesce(let(c, judge), F.lit(False))


def is_government(c: Column) -> Column:
    h = host(c)
    return h.rlike(r"(^|\.)gov\.(tw|taipei)$")


def origin(c: Column) -> Column:
    """Scheme and authority followed by the root path."""
    return F.concat(F.regexp_extract(c, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0), F.lit("/"))


def join_url(base: Column, ref: Column) -> Column:
    """Absolute form of a reference found on a page: absolute, host-relative, query-only or relative."""
    return let(ref, lambda r: _join(base, r))


def _join(base: Column, ref: Column) -> Column:
    base_scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    base_origin = F.regexp_extract(base, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", 0)
    no_query = F.regexp_extract(base, r"^[^?#]*", 0)
    folder = F.when(path(base) == "", "/").otherwise(F.regexp_replace(path(base), r"[^/]*$", ""))
    ups = F.length(F.regexp_extract(ref, r"^(?:\.\.?/)*", 0))
    up_steps = F.size(F.filter(F.split(F.regexp_extract(ref, r"^(?:\.\.?/)*", 0), "/"), lambda s: s == ".."))
    rest = ref.substr(ups + 1, F.length(ref))
    levels = F.filter(F.split(folder, "/"), lambda s: s != "")
    kept = F.slice(levels, F.lit(1), F.greatest(F.lit(0), F.size(levels) - up_steps))
    climbed = F.concat(
        base_origin, F.lit("/"), F.array_join(F.transform(kept, lambda s: F.concat(s, F.lit("/"))), ""), rest
    )
    return (
        F.when(ref.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), ref)
        .when(ref.startswith("//"), F.concat(base_scheme, ref))
        .when(ref.startswith("/"), F.concat(base_origin, ref))
        .when(ref.startswith("?"), F.concat(no_query, ref))
        .when(ref.startswith("#"), F.concat(F.regexp_extract(base, r"^[^#]*", 0), ref))
        .when(ref == "", base)
        .otherwise(climbed)
    )
