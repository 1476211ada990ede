"""Pages by URL: a pluggable fetcher behind ``mapInPandas``, with retries, snapshots, item pages and a prober."""

from __future__ import annotations

import hashlib
import random
import time
import urllib.error
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime
from email.utils import parsedate_to_datetime
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from harvestry.functions import html as H
from harvestry.functions.text import MAP_TEXT
from harvestry.operators.merge import overlay

#: (status, body, Retry-After in seconds or None); -1 is a timeout, -2 any other failure of transport.
Answer = tuple[int, str | None, float | None]
Fetcher = Callable[[str, dict[str, str]], Answer]
SCHEMA = "url string, status_code bigint, elapsed_s double, body string, retries bigint"
AGENTS = [f"Mozilla/5.0 ({system}) Browser/{version}.0" for system in ("X11; Linux x86_64", "Windows NT 10.0; Win64; x64", "Macintosh; Intel Mac OS X 13_6") for version in (124, 125, 126)]
OWN_AGENT = "harvestry/0.2"


def seconds_to_wait(value: str | None) -> float | None:
    """Retry-After: a number of seconds as it is, an HTTP date as the time until then (0 if past); None if it says nothing."""
    text = (value or "").strip()
    if text.lstrip("-").isdigit():
        return float(text)
    try:
        then = parsedate_to_datetime(text)
    except (TypeError, ValueError):
        return None
    then = then if then.tzinfo else then.replace(tzinfo=UTC)
    return max(0.0, (then - datetime.now(UTC)).total_seconds())


def agent_for(url: str, mode: str = "fixed", agents: list[str] | None = None) -> str:
    """The user agent of a request: one for all (``fixed``), any (``random``), or always the same per host (``per_domain``)."""
    agents = agents or AGENTS
    if mode == "random":
        return random.choice(agents)
    if mode == "per_domain":
        host = urlsplit(url).netloc.lower()
        return random.Random(hashlib.blake2b(host.encode(), digest_size=8).digest()).choice(agents)
    return OWN_AGENT


def http_fetcher(timeout: float = 2.0) -> Fetcher:
    """Plain HTTP GET."""

    def get(url: str, headers: dict[str, str]) -> Answer:
        try:
            with urllib.request.urlopen(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
                return r.status, decoded(r.read(), r.headers.get_content_charset()), None
        except urllib.error.HTTPError as e:
            return e.code, None, seconds_to_wait(e.headers.get("Retry-After"))
        except TimeoutError:
            return -1, None, None
        except urllib.error.URLError as e:
            return (-1 if isinstance(e.reason, TimeoutError) else -2), None, None
        except Exception:
            return -2, None, None

    return get


def decoded(body: bytes, charset: str | None) -> str:
    """Text of a page: by the stated character set, else by what fits (UTF-8, then the Greek code page)."""
    for name in (charset, "utf-8", "windows-1253"):
        try:
            if name:
                return body.decode(name)
        except (LookupError, UnicodeDecodeError):
            continue
    return body.decode("utf-8", "replace")


@dataclass(frozen=True)
class Policy:
    """How a page is asked for: so many times again, until a status in ``done`` (or, if ``again`` is given, unless one in it);
    ``wait`` seconds before each request, jittered; the n-th repetition waits ``backoff * 2^(n-1)``; a 429 or 503 is asked once
    more at once after its Retry-After (at most ``cap`` seconds) within the same attempt; ``concurrency`` requests at a time in
    each task; a user agent by ``agent_mode``."""

    retries: int = 0
    wait: float = 0.0
    backoff: float = 0.0
    cap: float = 60.0
    concurrency: int = 1
    agent_mode: str = "fixed"
    done: tuple[int, ...] = (200, 404)
    again: tuple[int, ...] = ()
    sleep: Callable[[float], None] = field(default=time.sleep, repr=False)


#: A session's usual policy: three repetitions, growing waits, only where the server is busy or broken.
SESSION = Policy(retries=3, backoff=0.5, again=(429, 500, 502, 503, 504))


def one(url: str, fetcher: Fetcher, policy: Policy) -> tuple[int, float, str | None, int]:
    """(status, seconds, body, repetitions used) of one URL."""
    start, status, body, used = time.perf_counter(), -2, None, 0
    for used in range(policy.retries + 1):
        if used and policy.backoff:
            policy.sleep(policy.backoff * 2 ** (used - 1))
        if policy.wait:
            policy.sleep(max(0.0, policy.wait * (1 + random.uniform(-0.2, 0.5))))
        headers = {"User-Agent": agent_for(url, policy.agent_mode), "Accept": "text/html,application/xhtml+xml;q=0.9,*/*;q=0.8", "Accept-Language": "el, en;q=0.8"}
        status, body, told = fetcher(url, headers)
        if status in (429, 503):
            pause = told if told and told > 0 else policy.wait * (1 + random.uniform(0.0, 1.0))
            if pause > 0:
                policy.sleep(min(policy.cap, pause))
                status, body, _ = fetcher(url, headers)
        if (policy.again and status not in policy.again) or (not policy.again and status in policy.done):
            break
    return status, time.perf_counter() - start, body if status == 200 else None, used


def fetch(urls: DataFrame, fetcher: Fetcher, policy: Policy = Policy(), column: str = "url", earlier: str | None = None) -> DataFrame:
    """One result per row of ``urls``: ``url, status_code, elapsed_s, body, retries``; the body is kept for 200 only.

    ``retries`` counts the repetitions, on top of those in the column ``earlier`` (null is 0) if it is named. Every task asks
    ``concurrency`` URLs at a time; null URLs give no row.
    """
    picked = urls.where(F.col(column).isNotNull()).select(F.col(column).alias("url"), (F.coalesce(earlier, F.lit(0)) if earlier else F.lit(0)).cast("long").alias("earlier"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with ThreadPoolExecutor(max_workers=max(1, policy.concurrency)) as pool:
            for pdf in batches:
                got = list(pool.map(lambda u: one(u, fetcher, policy), pdf["url"]))
                yield pd.DataFrame([(u, s, t, b, int(e) + n) for u, e, (s, t, b, n) in zip(pdf["url"], pdf["earlier"], got, strict=True)], columns=["url", "status_code", "elapsed_s", "body", "retries"])

    return picked.mapInPandas(run, SCHEMA)


def fetch_items(urls: DataFrame, fetcher: Fetcher, policy: Policy = Policy(), column: str = "url") -> DataFrame:
    """Item pages fetched and read: ``url, status_code, elapsed_s, external_link, metadata, metadata_num_fields, retries``.
    A page that isn't 200 has no link and an empty map."""
    pages = fetch(urls, fetcher, policy, column)
    read = pages.withColumn("link", H.html_external_link("body", "url")).withColumn("m", F.coalesce(H.html_metadata("body"), F.create_map().cast(MAP_TEXT)))
    meta = F.map_filter("m", lambda _, v: v != "")
    return read.select("url", "status_code", "elapsed_s", F.when(F.col("body").isNotNull(), F.col("link")).alias("external_link"), meta.alias("metadata"), F.size(meta).cast("long").alias("metadata_num_fields"), "retries")


def with_snapshots(urls: DataFrame, known: DataFrame | None, fetcher: Fetcher, policy: Policy = Policy(), column: str = "url") -> tuple[DataFrame, DataFrame]:
    """(a page for every URL, the pages newly fetched with 200, to be appended to the snapshots).

    Pages that ``known(url, body)`` has are taken from there and come out as 200 in 0 seconds; only the others are asked for.
    ``known`` has a URL once, as a snapshot sink that appends new pages only keeps it.
    """
    wanted = urls.where(F.col(column).isNotNull()).select(F.col(column).alias("url")).distinct()
    if known is None:
        fresh = fetch(wanted, fetcher, policy)
        return fresh, fresh.where("status_code = 200").select("url", "body")
    held = wanted.join(known.select("url", "body"), "url")
    fresh = fetch(wanted.join(known.select("url"), "url", "left_anti"), fetcher, policy)
    old = held.select("url", F.lit(200).cast("long").alias("status_code"), F.lit(0.0).alias("elapsed_s"), "body", F.lit(0).cast("long").alias("retries"))
    return old.unionByName(fresh), fresh.where("status_code = 200").select("url", "body")


def probe(urls: DataFrame, fetcher: Fetcher, rounds: int = 0, column: str = "url", policy: Policy = Policy()) -> DataFrame:
    """``url, status_code, elapsed_s`` of each distinct URL: a timeout is 0, another failure -1. Up to ``rounds`` further rounds
    ask again what isn't 200, and their results replace the earlier ones; each round's results are stored before the next."""
    from harvestry.session import stored

    def ask(some: DataFrame, label: str) -> DataFrame:
        s = F.col("status_code")
        got = fetch(some, fetcher, policy).select("url", F.when(s == -1, F.lit(0)).when(s < -1, F.lit(-1)).otherwise(s).cast("long").alias("status_code"), "elapsed_s")
        return stored(got, label)[0]

    state = ask(urls.where(F.col(column).isNotNull()).select(F.col(column).alias("url")).distinct(), "probe")
    for _ in range(rounds):
        open_ = state.where("status_code <> 200").select("url")
        if open_.isEmpty():
            break
        state = overlay(state, ask(open_, "probe"), "url", [])
    return state
