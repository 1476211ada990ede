"""Evaluation passages inside training text: an FM-index per training shard, searched backwards."""

from __future__ import annotations

import re
import unicodedata
from collections import defaultdict
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a window, errors allowed in it (one in eight), and words of a seed: two errors leave a run of five words.
WINDOW, ERRORS, SEED = 16, 2, 5
#: Words of one shard's index; characters of passages in one block (every block is searched in the same index), and distinct
#: words of all passages, which are sent to every executor (beyond it an error is raised: a query set isn't a corpus).
SHARD_WORDS, BLOCK_CHARS, MAX_VOCABULARY = 1_000_000, 32_000_000, 10_000_000
#: Raw words that a partition remembers, to fold each of them once.
KNOWN_WORDS = 500_000
_L = r"[^\W_]+(?:[\u0300-\u036f]+[^\W_]*)*"
_JOIN = r"(?:[|·­​-‍⁠﻿]+|[-‐]\s*\n[>\s]*|</?(?:b|i|em|strong|span|u|mark|sub|sup|font)\b[^<>]*>)"
_WORD = re.compile(rf"<[A-Za-z/!][^<>\n]*>|&(?:#\d+|[a-z]+);|({_L}(?:{_JOIN}{_L})*)")
_DROP = re.compile(rf"{_JOIN}")


def fold(word: str) -> str:
    """Case, accents, and marks inside the word don't matter."""
    w = unicodedata.normalize("NFKD", _DROP.sub("", word))
    return "".join(c for c in w if not unicodedata.combining(c)).lower().replace("ς", "σ")


def words_of(text: str) -> list[str]:
    return [fold(m[1]) for m in _WORD.finditer(text) if m[1]]


class FmIndex:
    """Suffix order, wavelet levels and sampled positions of one shard of word numbers.

    ``symbols`` holds a number per word, 0 for words outside the queries' vocabulary; ``starts`` the first word of
    each document. Documents are closed by a separator, which never matches and bounds the sort depth.
    """

    def __init__(self, symbols: np.ndarray, starts: np.ndarray, n_symbols: int, sample: int = 32) -> None:
        n = len(symbols)
        self.n, self.n_symbols = n, n_symbols
        order = _suffix_order(symbols, n_symbols)
        bwt = symbols[order - 1]
        self.first = np.concatenate(([0], np.cumsum(np.bincount(symbols, minlength=n_symbols))))[:-1]
        bits = max(1, int(n_symbols - 1).bit_length())
        self.levels = []
        current = bwt
        for level in range(bits - 1, -1, -1):
            ones = (current >> level) & 1
            rank = np.zeros(n + 1, np.int32)
            np.cumsum(ones, out=rank[1:])
            zeros = n - int(rank[-1])
            self.levels.append((level, rank, zeros))
            current = np.concatenate((current[ones == 0], current[ones == 1]))
        self.bwt = bwt
        inside = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
        marked = (inside % sample == 0)[order]  # every document's first word is sampled, so no walk leaves a document
        self.marks = np.concatenate(([0], np.cumsum(marked))).astype(np.int32)
        self.samples = order[marked]

    def rank(self, c: np.ndarray, i: np.ndarray) -> np.ndarray:
        """How often ``c`` stands in the first ``i`` places, by the wavelet levels."""
        lo = np.zeros_like(i)
        for level, rank, zeros in self.levels:
            one = (c >> level) & 1 == 1
            r, s = rank[i], rank[lo]
            i = np.where(one, zeros + r, i - r)
            lo = np.where(one, zeros + s, lo - s)
        return i - lo

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Backward search: of every phrase (a row of symbols) the interval of suffixes that begin with it."""
        lo, hi = np.zeros(len(phrases), np.int64), np.full(len(phrases), self.n, np.int64)
        live = np.arange(len(phrases))
        for j in range(phrases.shape[1] - 1, -1, -1):
            c = phrases[live, j]
            lo[live] = self.first[c] + self.rank(c, lo[live])
            hi[live] = self.first[c] + self.rank(c, hi[live])
            live = live[lo[live] < hi[live]]
        hi[lo >= hi] = lo[lo >= hi]
        return lo, hi

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of suffix rows: walk back to the next sampled position."""
        rows, steps = rows.astype(np.int64).copy(), np.zeros(len(rows), np.int64)
        out = np.full(len(rows), -1, np.int64)
        live = np.arange(len(rows))
        while len(live):
            r = rows[live]
            hit = self.marks[r + 1] > self.marks[r]
            out[live[hit]] = self.samples[self.marks[r[hit]]] + steps[live[hit]]
            live = live[~hit]
            c = self.bwt[rows[live]]
            rows[live] = self.first[c] + self.rank(c, rows[live])
            steps[live] += 1
        return out


def _suffix_order(symbols: np.ndarray, n_symbols: int) -> np.ndarray:
    """Suffix array by prefix doubling; from the second round on only suffixes that are still tied are sorted.

    The greatest symbol is the separator: separators differ from each other (by place), so ties end with a document.
    """
    n = len(symbols)
    sep = n_symbols - 1
    key = symbols.astype(np.int64)
    at_sep = np.flatnonzero(symbols == sep)
    key[at_sep] = sep + np.arange(len(at_sep))
    width = int(key.max(initial=0) + 1).bit_length()
    depth = max(1, 62 // width)
    packed = np.zeros(n, np.int64)
    ended = np.zeros(n, bool)
    for d in range(depth):
        shifted = np.zeros(n, np.int64)
        if d < n:
            shifted[: n - d] = key[d:] + 1
        shifted[ended] = 0
        packed = (packed << width) | np.minimum(shifted, (1 << width) - 1)
        ended |= shifted > sep
    order = np.argsort(packed, kind="stable")
    rank, tied = _ranks(order, packed[order])
    h = depth
    while len(tied):
        follow = np.where(tied + h < n, rank[np.minimum(tied + h, n - 1)] + 1, 0)
        sub = np.lexsort((follow, rank[tied]))
        tied_sorted, f, old = tied[sub], follow[sub], rank[tied[sub]]
        # a tie group occupies rank .. rank + size - 1, and its members are consecutive after the sort
        new_group = np.append(True, old[1:] != old[:-1])
        start = np.maximum.accumulate(np.where(new_group, np.arange(len(old)), 0))
        place = old + np.arange(len(old)) - start
        order[place] = tied_sorted
        changed = new_group | np.append(True, f[1:] != f[:-1])
        rank[tied_sorted] = np.maximum.accumulate(np.where(changed, place, 0))
        last = np.append(changed[1:], True)
        tied = tied_sorted[~(changed & last)]
        h *= 2
    return order


def _ranks(order: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    new = np.append(True, keys[1:] != keys[:-1]) if len(keys) else np.zeros(0, bool)
    rank = np.empty(len(order), np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) if len(order) else 0
    alone = new & np.append(new[1:], True) if len(order) else new
    return rank, order[~alone]


def add_words(vocabulary: dict[str, int], text: str | None) -> None:
    """Number the words of a passage, and its neighbouring words written as one."""
    words = words_of(text or "")
    for w in [*words, *map("".join, zip(words, words[1:], strict=False))]:
        vocabulary.setdefault(w, len(vocabulary) + 1)


class Items:
    """Passages as word numbers, and their seeds: every run of words long enough that the allowed errors can't hit them all.

    A window of 16 words with two errors keeps a run of five; a shorter passage of n words with n // 8 errors keeps one of
    (n - errors) / (errors + 1) words. Seeds hold the items and places that have them.
    """

    def __init__(self, items: list[tuple[int, str]], vocabulary: dict[str, int] | None = None) -> None:
        if vocabulary is None:
            vocabulary = {}
            for _, text in items:
                add_words(vocabulary, text)
        self.vocabulary = vocabulary
        self.passages: dict[int, list[int]] = {}
        self.joined: dict[int, tuple[int, int]] = {}
        self.seeds: dict[tuple[int, ...], list[tuple[int, int]]] = defaultdict(list)
        for item, text in items:
            words = words_of(text or "")
            ids = [vocabulary[w] for w in words]
            if not ids:
                continue
            self.passages[item] = ids
            for a, b, one, two in zip(words, words[1:], ids, ids[1:], strict=False):
                self.joined[vocabulary[a + b]] = (one, two)
            errors = min(ERRORS, len(ids) // 8)
            step = min(SEED, -(-(len(ids) - errors) // (errors + 1)))
            for i in range(len(ids) - step + 1):
                self.seeds[tuple(ids[i : i + step])].append((item, i))
        for w in {w for ids in self.passages.values() for w in ids}:
            self.joined.pop(w, None)  # a word of its own is no pair
        by_size: dict[int, list[tuple[int, ...]]] = defaultdict(list)
        for s in self.seeds:
            by_size[len(s)].append(s)
        self.by_size = {k: (v, np.array(v, np.int64)) for k, v in by_size.items()}


def aligned(passage: list[int], doc: list[int], i: int, p: int) -> tuple[int, int] | None:
    """The (first, last + 1) document words of the windows around the match passage[i] = doc[p], or None.

    A window has WINDOW passage words, of which the first and the last stand there, with at most one error in eight words;
    all windows that hold the match lie between the earliest and the latest of them. A passage that errors at its ends could
    make shorter than a window is compared as a whole, with one error in eight at any place, its ends included.
    """
    size = min(WINDOW, len(passage))
    most = min(ERRORS, size // 8)
    starts = range(min(i, len(passage) - size), max(0, i - size + 1) - 1, -1)

    def window(order) -> tuple[int, int] | None:  # noqa: ANN001
        for a in order:
            want = passage[a : a + size]
            for shift in sorted(range(-most, most + 1), key=abs):
                d = p - (i - a) + shift
                if d < 0 or d >= len(doc) or doc[d] != want[0]:
                    continue
                reach = _match(want, doc, d, most)
                if reach is not None:
                    return d, reach
        return None

    latest = window(starts)
    if latest:
        earliest = window(reversed(starts))
        return min(latest[0], earliest[0]), max(latest[1], earliest[1])
    most = min(ERRORS, len(passage) // 8)
    if most and len(passage) - most < WINDOW:
        low = max(0, p - i - most)
        return _anywhere(passage, doc[low : p - i + len(passage) + most], low, most)
    return None


def _anywhere(want: list[int], stretch: list[int], low: int, most: int) -> tuple[int, int] | None:
    """The part of ``stretch`` (which begins at ``low``) with the least edits to ``want``, if these are few enough."""
    row = [(0, j) for j in range(len(stretch) + 1)]
    for i, w in enumerate(want, 1):
        new = [(i, 0)]
        for j, d in enumerate(stretch, 1):
            same = (row[j - 1][0] + (w != d), row[j - 1][1])
            new.append(min(same, (row[j][0] + 1, row[j][1]), (new[j - 1][0] + 1, new[j - 1][1])))
        row = new
    cost, end = min((c, j) for j, (c, _) in enumerate(row))
    return (low + row[end][1], low + end) if cost <= most and end > row[end][1] else None


def _match(want: list[int], doc: list[int], d: int, most: int) -> int | None:
    """Edit distance of ``want`` to a stretch of ``doc`` from ``d`` on, in a band; the end of the best stretch."""
    n, band = len(want), most
    if doc[d : d + n] == want:
        return d + n
    stretch = doc[d : d + n + band]
    big = most + 1
    row = {j: j for j in range(min(band, len(stretch)) + 1)}
    for i in range(1, n + 1):
        new: dict[int, int] = {}
        for j in range(max(0, i - band), min(len(stretch), i + band) + 1):
            best = min(row.get(j, big) + 1, new.get(j - 1, big) + 1)
            if j:
                best = min(best, row.get(j - 1, big) + (want[i - 1] != stretch[j - 1] or not stretch[j - 1]))
            new[j] = best
        row = new
        if min(row.values(), default=big) > most:
            return None
    ends = [j for j, cost in row.items() if j and cost <= most and stretch[j - 1] == want[-1]]
    return d + min(ends, key=lambda j: (row[j], j)) if ends else None


def _present(passage: list[int], doc: list[int], i: int, p: int) -> bool:
    """Cheap and exact to reject: enough words of some window around the seed stand near the match."""
    size = min(WINDOW, len(passage))
    most = min(ERRORS, size // 8)
    near = set(doc[max(0, p - size - most) : p + size + most + SEED])
    a, b = max(0, i - size + 1), min(len(passage), i + size + SEED)
    hits = [w in near for w in passage[a:b]]
    have = sum(hits[:size])
    for k in range(len(hits) - size + 1):
        if k:
            have += hits[k + size - 1] - hits[k - 1]
        if have >= size - most:
            return True
    return False


def _evened(ids: list[int], text: str, vocabulary: dict[str, int], joined: dict[int, tuple[int, int]]) -> tuple[list[int], list[int], list[int]]:
    """A document's words with spacing evened out: (numbers, and of each the first and last word of the text it stands for).

    Two words of which one is unknown and that make a passage word together count as that word; a word that is two
    neighbouring passage words written together counts as both.
    """
    words: list[str] | None = None
    out, first, last = [], [], []
    j = 0
    while j < len(ids):
        if j + 1 < len(ids) and not (ids[j] and ids[j + 1]):
            words = words or words_of(text)
            one = vocabulary.get(words[j] + words[j + 1], 0)
            if one and one not in joined:
                out.append(one)
                first.append(j)
                last.append(j + 1)
                j += 2
                continue
        for part in joined.get(ids[j], (ids[j],)):
            out.append(part)
            first.append(j)
            last.append(j)
        j += 1
    return out, first, last


def scan(batches: Iterator[pd.DataFrame], *blocks: Callable[[], Items] | Items) -> Iterator[pd.DataFrame]:
    """Index the documents of a partition shard by shard, search every block of items in each index, and yield
    ``doc_id, item_id, first_char, end_char``."""
    load = [(lambda b=b: b) if isinstance(b, Items) else b for b in blocks]
    if not load:
        return
    vocabulary = load[0]().vocabulary
    sep = len(vocabulary) + 1

    class Numbers(dict):
        def __missing__(self, raw: str) -> int:
            if len(self) > KNOWN_WORDS:
                self.clear()
                self[""] = -1
            self[raw] = v = vocabulary.get(fold(raw), 0)
            return v

    known = Numbers()
    known[""] = -1  # markup
    shard: list[tuple] = []
    size = 0
    for pdf in batches:
        for doc_id, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            if not text:
                continue
            ids = np.fromiter(map(known.__getitem__, _WORD.findall(text)), np.int64)
            ids = ids[ids >= 0]
            shard.append((doc_id, ids, text))
            size += len(ids) + 1
            if size >= SHARD_WORDS:
                yield from _search(shard, load, sep)
                shard, size = [], 0
    if shard:
        yield from _search(shard, load, sep)


def _search(shard: list[tuple], load: list[Callable[[], Items]], sep: int) -> Iterator[pd.DataFrame]:
    lengths = np.array([len(ids) + 1 for _, ids, _ in shard])
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1]
    symbols = np.full(int(lengths.sum()), sep, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[starts + lengths - 1] = False
    symbols[inside] = np.concatenate([ids for _, ids, _ in shard])
    index = FmIndex(symbols, starts, sep + 1)
    for block in load:
        items = block()
        # a word of the text begins at most one seed of each length, so the places are no more than the text's words
        seeds, docs, places = [], [], []
        for names, matrix in items.by_size.values():
            lo, hi = index.search(matrix)
            found = np.flatnonzero(hi > lo)
            counts = (hi - lo)[found]
            rows = np.repeat(lo[found] - np.concatenate(([0], np.cumsum(counts)))[:-1], counts) + np.arange(int(counts.sum()))
            at = index.locate(rows)
            d = np.searchsorted(starts, at, side="right") - 1
            seeds += [names[k] for k in np.repeat(found, counts)]
            docs.append(d)
            places.append(at - starts[d])
        if not seeds:
            continue
        docs, places = np.concatenate(docs), np.concatenate(places)
        order = np.lexsort((places, docs))
        bounds = np.flatnonzero(np.append(True, np.diff(docs[order]) != 0))
        out = []
        for a, b in zip(bounds, np.append(bounds[1:], len(order)), strict=True):
            out += _verified(shard[docs[order[a]]], [(int(places[k]), seeds[k]) for k in order[a:b]], items)
        yield pd.DataFrame(out, columns=["doc_id", "item_id", "first_char", "end_char"]).astype("int64")


def _verified(doc: tuple, hits: list[tuple[int, tuple]], items: Items) -> list[tuple]:
    """Merged removal spans of one document, from its seeds in the order of their places."""
    doc_id, ids, text = doc
    per_item: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for p, seed in hits:
        for item, i in items.seeds[seed]:
            per_item[item].append((p, i))
    words, first, last = _evened(ids.tolist(), text, items.vocabulary, items.joined)
    place = {j: k for k, j in enumerate(first)}
    out, spans = [], None
    for item, at in per_item.items():
        passage = items.passages[item]
        merged: list[list[int]] = []
        for p, i in at:
            p = place.get(p, -1)
            if p < 0 or merged and p + SEED <= merged[-1][1]:
                continue
            if not _present(passage, words, i, p):
                continue
            window = aligned(passage, words, i, p)
            if window:
                if merged and window[0] <= merged[-1][1] + SEED:
                    merged[-1][1] = max(merged[-1][1], window[1])
                else:
                    merged.append(list(window))
        if merged:
            spans = spans or [m.span(1) for m in _WORD.finditer(text) if m[1]]
            out += [(doc_id, item, spans[first[a]][0], spans[last[b - 1]][1]) for a, b in merged]
    return out


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", passage: str = "passage") -> DataFrame:
    """Merged removal spans of leaked passages: ``doc_id, item_id, first_char, end_char`` (characters from 0, end exclusive).

    Every partition of documents is read once and indexed as it is read, a shard of about SHARD_WORDS words at a time, and all
    seeds of all passages are searched in it, however many blocks of passages there are; hits are checked exactly (see
    ``aligned``) and overlapping spans of an item merged. There is no shuffle. Passages and their vocabulary are the query
    set: they come to the driver and go to all executors, a block of BLOCK_CHARS characters at a time; a vocabulary beyond
    MAX_VOCABULARY raises a ValueError. Null or empty texts and passages match nothing; a passage of fewer than 16 words
    must stand there whole but for one error in eight words; repeated rows each come out.
    """
    spark = docs.sparkSession
    asked = items.where(F.col(passage).isNotNull()).select(F.col(item_id).cast("long").alias("i"), F.col(passage).alias("p"))
    vocabulary: dict[str, int] = {}
    blocks, own, size = [], [], 0
    for r in asked.toLocalIterator():
        own.append((r["i"], r["p"]))
        add_words(vocabulary, r["p"])
        if len(vocabulary) > MAX_VOCABULARY:
            raise ValueError(f"the passages have over {MAX_VOCABULARY} distinct words")
        size += len(r["p"])
        if size >= BLOCK_CHARS:
            blocks.append(spark.sparkContext.broadcast(own))
            own, size = [], 0
    if own:
        blocks.append(spark.sparkContext.broadcast(own))
    words = spark.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        kept: dict[int, Items] = {}

        def load(k: int) -> Items:
            if k not in kept:
                kept.clear()  # one block at a time
                kept[k] = Items(blocks[k].value, words.value)
            return kept[k]

        yield from scan(batches, *[partial(load, k) for k in range(len(blocks))])

    schema = "doc_id bigint, item_id bigint, first_char bigint, end_char bigint"
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInPandas(run, schema)
