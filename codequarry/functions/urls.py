"""Repository URLs: parts, checks, owner and name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from codequarry import fixed_values as V
from codequarry.functions.text import col, strip

# scheme, authority, path of a URL; query and fragment are left out
_URL = r"^([A-Za-z][A-Za-z0-9+.-]*):(?://([^/?#]*))?([^?#]*)"


def _given(url: Column | str) -> Column:
    return F.regexp_replace(strip(url), r"[\t\r\n]", "")


def scheme(url: Column | str) -> Column:
    return F.lower(F.regexp_extract(_given(url), _URL, 1))


def host(url: Column | str) -> Column:
    authority = F.regexp_extract(_given(url), _URL, 2)
    return F.lower(F.regexp_extract(authority, r"^(?:.*@)?([^:@]*)(?::\d*)?$", 1))


def path(url: Column | str) -> Column:
    """Path without parameters, outer slashes and a ``.git`` ending."""
    bare = F.regexp_replace(F.regexp_extract(_given(url), _URL, 3), r";[^/]*$", "")
    return F.regexp_replace(F.btrim(bare, F.lit("/")), r"\.git\z", "")


def owner(url: Column | str) -> Column:
    return F.split_part(path(url), F.lit("/"), F.lit(1))


def repository_name(url: Column | str) -> Column:
    """``owner/name``; null where the path has a single part."""
    parts = F.split(path(url), "/", -1)
    return F.when(F.size(parts) >= 2, F.concat_ws("/", parts[0], parts[1]))


def normalised(url: Column | str) -> Column:
    return F.rtrim(strip(url), F.lit("/"))


def reject_reason(url: Column | str, hosts: str | list[str] = V.ALLOWED_HOSTS) -> Column:
    """Null for an acceptable repository URL, else the first rule it breaks."""
    allowed = hosts.split(",") if isinstance(hosts, str) else hosts
    allowed = [h.strip().lower() for h in allowed if h.strip()]
    parts = F.filter(F.split(path(url), "/", -1), lambda p: p != "")
    unsafe = F.exists(F.slice(parts, 1, 2), lambda p: p.contains("..") | p.startswith("."))
    return (
        F.when(col(url).isNull() | ~scheme(url).isin("http", "https"), "scheme")
        .when(~host(url).isin(*allowed), "host")
        .when(F.size(parts) < 2, "parts")
        .when(unsafe, "unsafe")
    )
