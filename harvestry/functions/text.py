"""Text functions as column expressions."""

from __future__ import annotations

import unicodedata
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType


MAP_TEXT = "map<string,string>"


def strip_accents(text: str) -> str:
    return unicodedata.normalize("NFC", "".join(c for c in unicodedata.normalize("NFD", text) if unicodedata.category(c) != "Mn"))


@F.pandas_udf(StringType())
def normalized(s: pd.Series) -> pd.Series:
    """Trimmed, lower case, without accents; null gives ''. Arrow batches; apply it to distinct values."""
    return s.map(lambda v: strip_accents((v or "").strip().lower()))


@F.pandas_udf(DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    """Ratio of matching blocks of two texts in lower case."""
    return pd.Series([SequenceMatcher(None, (x or "").lower(), (y or "").lower()).ratio() for x, y in zip(a, b, strict=True)])


def plain_greek(c: Column) -> Column:
    """Lower case without Greek accents, in the JVM (single code points only)."""
    return F.translate(F.lower(F.trim(c)), "άέήίόύώϊϋΐΰς", "αεηιουωιυιυσ")


def json_map(text: Column) -> Column:
    """``map<string,string>`` of a JSON object, empty where it isn't one."""
    return F.coalesce(F.from_json(text, "map<string,string>"), F.create_map().cast("map<string,string>"))


def first_field(m: Column, *names: str) -> Column:
    """The first of the fields with a non-empty value, else ''."""
    return F.coalesce(*[F.nullif(F.try_element_at(m, F.lit(n)), F.lit("")) for n in names], F.lit(""))


def all_english(title: Column) -> Column:
    """Non-empty and every letter an ASCII one."""
    return (title != "") & ~title.rlike(r"[^\P{L}A-Za-z]")


def counted(text: Column, unit: str = "τεκμήρια") -> Column:
    """The number before the unit, thousands separators dropped."""
    return F.regexp_replace(F.regexp_extract(text, rf"([\d.,]+)\s+{unit}", 1), "[.,]", "").try_cast("long")


def total_pages(html: Column, per_page: int = 30) -> Column:
    """Pages of a listing: stated by script, else items over page size, else "pages: N", else counted items; null if none."""
    js = lambda name: F.regexp_extract(html, rf"var\s+{name}\s*=\s*['\"](\d+)['\"]\s*;", 1).try_cast("long")
    size = F.greatest(F.lit(1), js("pageSize"))
    by_items = F.when(js("itemsNum").isNotNull() & js("pageSize").isNotNull(), F.greatest(F.lit(1), F.ceil(js("itemsNum") / size)))
    said = F.regexp_extract(html, r"(?i)pages:\s*(\d+)", 1).try_cast("long")
    by_count = F.when(counted(html).isNotNull(), F.greatest(F.lit(1), F.ceil(counted(html) / per_page)))
    return F.coalesce(js("maxPages"), by_items, said, by_count)


def pages_source(html: Column) -> Column:
    """Which of the signs told the number of pages."""
    return F.when(html.rlike(r"var\s+maxPages\s*="), "maxPages").when(html.rlike(r"var\s+itemsNum\s*="), "itemsNum").when(F.lower(html).contains("pages:"), "pages").when(counted(html).isNotNull(), "count").otherwise("none")


def retry_after(value: Column, now: Column) -> Column:
    """Seconds to wait: a number as it is, an HTTP date as the time until then (at least 0), else 0."""
    t = F.trim(value)
    then = F.try_to_timestamp(F.regexp_extract(t, r"^[A-Za-z]{3}, (\d{2} [A-Za-z]{3} \d{4} \d{2}:\d{2}:\d{2}) GMT$", 1), F.lit("dd MMM yyyy HH:mm:ss"))
    return F.coalesce(F.when(t.rlike(r"^-?\d+$"), t.try_cast("double")), F.greatest(F.lit(0.0), (F.unix_micros(then) - F.unix_micros(now)) / 1e6), F.lit(0.0))


def safe_name(c: Column) -> Column:
    """Letters, digits, hyphens and underscores; all else an underscore."""
    return F.regexp_replace(c, r"[^\p{L}\p{N}_-]", "_")


def eta_text(seconds: Column) -> Column:
    """Minutes and seconds."""
    s = F.floor(seconds)
    return F.concat(F.floor(s / 60).cast("string"), F.lit(":"), F.lpad((s % 60).cast("string"), 2, "0"))


def progress_bar(done: Column, total: Column, width: int = 20) -> Column:
    n = F.floor(F.least(F.lit(1.0), done / F.greatest(F.lit(1), total)) * width).cast("int")
    return F.concat(F.repeat(F.lit("#"), n), F.repeat(F.lit("-"), F.lit(width) - n))


def agent_of(key: Column, agents: list[str]) -> Column:
    """A user agent that depends on the key only."""
    return F.element_at(F.array(*[F.lit(a) for a in agents]), (F.pmod(F.xxhash64(key), F.lit(len(agents))) + 1).cast("int"))


def jittered(wait: Column, seed: int, low: float = -0.2, high: float = 0.5) -> Column:
    return wait * (1 + F.rand(seed) * (high - low) + low)


def json_list(items: Column) -> Column:
    """A list as JSON text with a blank behind each comma, as the harvest's link columns hold it; null stays null."""
    return F.when(items.isNotNull(), F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: F.coalesce(F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1), F.lit("null"))), ", "), F.lit("]")))


@F.pandas_udf(StringType())
def percent_text(part: pd.Series, whole: pd.Series) -> pd.Series:
    """A share as a percentage with one decimal, rounded as C prints it; of nothing it is 0.0%. For small report tables."""
    return pd.Series([f"{100.0 * p / max(1, w):.1f}%" for p, w in zip(part, whole, strict=True)])


def safe_path_name(url: Column) -> Column:
    """A file name from the last two parts of a URL's path."""
    parts = F.filter(F.split(F.coalesce(F.try_parse_url(url, F.lit("PATH")), F.lit("")), "/"), lambda x: x != "")
    return safe_name(F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - 1), F.lit(2)), "_"))


@F.pandas_udf(StringType())
def agent_of_host(host: pd.Series) -> pd.Series:
    """The user agent that a host always gets; apply it to distinct hosts."""
    from harvestry.sources.fetch import agent_for

    return host.map(lambda h: agent_for(f"//{h or ''}", "per_domain"))
