"""URL functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


#: A URL that is already written plainly: nothing but scheme, lower-case host, simple path and the choosing parameter.
_PLAIN = r"^https?://[a-z0-9\-]+(?:\.[a-z0-9\-]+)+(?:/[A-Za-z0-9_\-]+)+(?:\?%s=[A-Za-z0-9_\-]+)?\z"


def page_of(url: Column, choosing: str = "part") -> Column:
    """The page a URL leads to, however written: host, decoded path without empty or dot segments, and the
    ``choosing`` parameter. Scheme, default ports, letter case of the host, other parameters, the fragment and blanks
    around it don't matter. Null stays null; a text that isn't a URL is treated as a path.
    """
    # one pass splits the text: authority (without user and default port), path, query
    shape = r"(?s)^\s*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://(?:[^/?#@]*@)?([^/?#:]*)(?::(?:80|443)?(?=[/?#\s]|$))?([^/?#\s]*))?([^?#]*?)(?:\?([^#]*?))?(?:#.*)?\s*$"
    blank = r"[\s ​﻿]+"
    u = F.regexp_replace(url, f"^{blank}|{blank}$", "")
    host = F.lower(F.concat(F.regexp_extract(u, shape, 1), F.regexp_extract(u, shape, 2)))
    raw = F.regexp_extract(u, shape, 3)
    decoded = F.when(raw.contains("%"), F.coalesce(F.try_url_decode(F.replace(F.regexp_replace(raw, "(?i)%2f", "%252F"), F.lit("+"), F.lit("%2B"))), raw)).otherwise(raw)
    steps = F.aggregate(
        F.split(decoded, "/"), F.array().cast("array<string>"),
        lambda acc, x: F.when(x.isin("", "."), acc).when(x == "..", F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0)))).otherwise(F.concat(acc, F.array(x))),
    )
    path = F.when(decoded.rlike(r"//|/\.|/$"), F.concat(F.lit("/"), F.array_join(steps, "/"))).otherwise(decoded)
    chosen = F.regexp_extract(u, rf"(?s)^[^#]*[?&;]{choosing}=([^&;#]*)", 1)
    full = F.concat(host, path, F.when(chosen != "", F.concat(F.lit(f"?{choosing}="), chosen)).otherwise(""))
    # most are plain: one cheap test spares them the parsing, with the same result
    return F.when(url.rlike(_PLAIN % choosing), F.substring_index(url, "://", -1)).otherwise(full)


def spelling_of(url: Column) -> Column:
    """A small number that tells how a URL is written (bounded: 256 values); 0 is the plain form."""
    marks = [
        url.rlike(r"^\s|\s$"), ~url.startswith("https://"), url.rlike(r"^[a-z]+://[^/?#]*[A-Z]"), url.rlike(r"^[A-Za-z]+://[^/?#]*:\d"),
        url.rlike(r"/([?#]|\s*$)|[^:]//|/\.\.?/"), url.contains("#"), url.rlike(r"[?&](?!part=)"), url.contains("%"),
    ]
    total = F.lit(0)
    for i, m in enumerate(marks):
        total = total + F.when(m, 1 << i).otherwise(0)
    plain = url.startswith("https://") & url.rlike(_PLAIN % "part")
    return F.when(plain, F.lit(0)).otherwise(F.coalesce(total, F.lit(0))).cast("int")


def domain_of(url: Column) -> Column:
    """Lower-case authority, '' where there is none."""
    return F.coalesce(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), F.lit(""))


def last_segment(url: Column) -> Column:
    """Last path segment, trailing slashes ignored; '' without a path."""
    return F.coalesce(F.element_at(F.split(F.rtrim(F.try_parse_url(url, F.lit("PATH")), F.lit("/")), "/"), -1), F.lit(""))
