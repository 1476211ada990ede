"""Free-entered values mapped to a canonical list: prefix-filter set-similarity join."""

from __future__ import annotations

import re
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from harvestry.llm.lookalikes import LOOKALIKES
from harvestry.session import stored

#: Greek letters in Latin, as depositors write them.
GREEK_TO_LATIN = dict(zip("αβγδεζηθικλμνξοπρσςτυφχψω", "a v g d e z i th i k l m n x o p r s s t y f ch ps o".split(), strict=True))
#: Latin and Cyrillic letters that stand in for a Greek one without looking quite the same.
NEARLY_GREEK = {"а": "α", "a": "α", "е": "ε", "e": "ε", "к": "κ", "k": "κ", "і": "ι", "i": "ι", "у": "γ", "х": "χ", "x": "χ", "т": "τ", "u": "υ"}


def _stand_ins(script: str) -> dict[str, str]:
    """Look-alike letter -> the letter of ``script`` that it looks like."""
    found = {}
    for group in LOOKALIKES:
        own = [c for c in group if unicodedata.name(c).startswith(script)]
        if own:
            found.update({c: own[0] for c in group if c != own[0]})
    return found


TO_GREEK, TO_LATIN = NEARLY_GREEK | _stand_ins("GREEK"), _stand_ins("LATIN")
_GREEK = re.compile("[Α-Ωα-ω]")
_LATIN = re.compile("[A-Za-z]")
_BREAK = re.compile(r"[:꞉|/∕⁄\\=>()\[\]{}«»\"“”;•·]|\s[-–—]\s|--+|—")
_WORD = re.compile(r"[^\W\d_]+\.?")


def _word(w: str) -> str:
    """One script per word (that of the letters which only it has, else of most letters), then lower Latin letters."""
    greek, latin = _GREEK.findall(w), _LATIN.findall(w)
    sure_greek, sure_latin = sum(c not in TO_LATIN for c in greek), sum(c not in TO_GREEK for c in latin)
    as_greek = sure_greek > sure_latin or (sure_greek == sure_latin and len(greek) > len(latin))
    table = TO_GREEK if as_greek else TO_LATIN
    w = "".join(table.get(c, c) for c in w).lower()
    return "".join(GREEK_TO_LATIN.get(c, c) for c in w)


@lru_cache(maxsize=200_000)
def segments(text: str) -> list[str]:
    """The parts of a value that may name an entry, folded to plain Latin words (a cut-off word keeps its dot)."""
    s = unicodedata.normalize("NFKC", text)
    s = "".join(c for c in s if unicodedata.category(c) != "Cf")
    s = re.sub(r"(?<=[a-zα-ω])(?=[A-ZΑ-Ω])", " ", s) if re.search(r"\w/\w|^\w+$", s) and not s.isupper() else s
    s = unicodedata.normalize("NFD", s.replace("_", " "))
    s = "".join(c for c in s if not unicodedata.combining(c))
    found: dict[str, None] = {}
    for part in _BREAK.split(s):
        for piece in (part, *(part.split(",") if "," in part else ())):
            words = [_word(w.rstrip(".")) + ("." if w.endswith(".") and len(w) > 2 else "") for w in _WORD.findall(piece.replace("-", " ").replace("‐", " ").replace("‑", " "))]
            words = [w for w in words if w.rstrip(".")]
            if words:
                found[" ".join(words)] = None
    return list(found)


def tokens(segment: str) -> list[str]:
    """Padded letter pairs of every word; the n-th occurrence of a pair is a token of its own. A cut-off word has no end."""
    seen: dict[str, int] = {}
    out = []
    for w in segment.split(" "):
        w = f"^{w[:-1]}" if w.endswith(".") else f"^{w}$"
        for a, b in zip(w, w[1:], strict=False):
            seen[a + b] = n = seen.get(a + b, 0) + 1
            out.append(f"{a}{b}{n}" if n > 1 else a + b)
    return out


@F.pandas_udf(ArrayType(StringType()))
def _segments(s: pd.Series) -> pd.Series:
    return s.map(segments)


@F.pandas_udf(ArrayType(StringType()))
def _tokens(s: pd.Series) -> pd.Series:
    return s.map(tokens)


def _ordered(side: DataFrame, key: str, rank: DataFrame) -> DataFrame:
    """Token lists with the rarest first: ``key, toks, size``. Tokens are letter pairs, so there are as many ranks as pairs of
    letters in use; the planner sends them to all executors while they are small and joins by shuffling beyond that."""
    flat = side.select(key, F.explode("toks").alias("tok")).join(rank, "tok")
    return flat.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("df", "tok"))).alias("t")).select(key, F.transform("t", lambda x: x["tok"]).alias("toks"), F.size("t").alias("size"))


def similar(left: DataFrame, right: DataFrame, threshold: float) -> DataFrame:
    """All pairs with Jaccard similarity of at least ``threshold``: ``lkey, rkey, jaccard``.

    ``left(lkey, toks)`` and ``right(rkey, toks)`` hold distinct sets. Tokens are ordered by their rarity over both
    sides; only prefixes of ``size - ceil(t * size) + 1`` tokens are joined; pairs that fail the length or the
    positional bound are dropped before the exact check. Nothing is capped: a pair at the threshold is always found.
    """
    both = left.select(F.explode("toks").alias("tok")).unionByName(right.select(F.explode("toks").alias("tok")))
    rank, _ = stored(both.groupBy("tok").agg(F.count(F.lit(1)).alias("df")), "rank")
    a, b = _ordered(left, "lkey", rank), _ordered(right, "rkey", rank)
    t = F.lit(threshold)
    prefix = lambda: F.slice("toks", F.lit(1), (F.col("size") - F.ceil(t * F.col("size") - 1e-9) + 1).cast("int"))
    pa = a.select("lkey", F.col("size").alias("ls"), F.posexplode(prefix()).alias("i", "tok"))
    pb = b.select("rkey", F.col("size").alias("rs"), F.posexplode(prefix()).alias("j", "tok"))
    need = F.ceil(t / (t + 1) * (F.col("ls") + F.col("rs")) - 1e-9)
    bound = 1 + F.least(F.col("ls") - F.col("i") - 1, F.col("rs") - F.col("j") - 1)
    met = pa.join(pb, "tok").where((F.col("rs") >= t * F.col("ls") - 1e-9) & (F.col("ls") >= t * F.col("rs") - 1e-9))
    # the first common token has the least positions: its bound is the loosest, so keep a pair if any match passes
    pairs = met.groupBy("lkey", "rkey").agg(F.max(bound).alias("most"), F.first("ls").alias("ls"), F.first("rs").alias("rs")).where(F.col("most") >= need)
    full = pairs.join(a.select("lkey", F.col("toks").alias("lt")), "lkey").join(b.select("rkey", F.col("toks").alias("rt")), "rkey")
    common = F.size(F.array_intersect("lt", "rt"))
    jaccard = common / (F.col("ls") + F.col("rs") - common)
    return full.select("lkey", "rkey", jaccard.alias("jaccard")).where(F.col("jaccard") >= t - 1e-9)


def map_values(df: DataFrame, text: str, labels: DataFrame, label_id: str, names: list[str], keep: list[str], threshold: float = 0.42) -> DataFrame:
    """``keep`` columns of each row whose ``text`` says something and isn't exactly a name, with ``label_id`` and ``jaccard``.

    Distinct texts are folded (width, case, accents, look-alikes, Greek to Latin) and cut at separators into segments;
    the segments are joined to the names by set similarity of letter pairs, and the best match over all segments wins
    (ties: the smaller id). -1 and a null similarity: no segment reaches the threshold, the value is unmatched. Null and
    blank texts give no row; repeated rows each come out; empty tables give no rows or only -1.
    """
    listed = [labels.select(F.col(label_id).alias("id"), F.col(n).alias("name")) for n in names]
    every = listed[0]
    for x in listed[1:]:
        every = every.unionByName(x)
    every = every.where(F.col("name").isNotNull())
    blank = F.regexp_replace(F.col(text), r"[\s\p{Z}\p{Cf}]+", "") == ""
    # own names for what is kept, so that no column of the input can clash with one of the operator's
    kept = df.where(F.col(text).isNotNull() & ~blank)
    rows = kept.select(F.col(text).alias("_value"), *[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)])
    values = rows.groupBy(F.col("_value").alias("_text")).agg(F.lit(1).alias("_1"))
    values = values.join(every.select(F.col("name").alias("_text")).distinct(), "_text", "left_anti")
    cut, _ = stored(values.select("_text", F.explode_outer(_segments("_text")).alias("lkey")), "segments")
    left, _ = stored(cut.where(F.col("lkey").isNotNull()).select("lkey").distinct().withColumn("toks", _tokens("lkey")), "tokens")
    named, _ = stored(every.select("id", F.explode(_segments("name")).alias("rkey")), "names")
    right = named.select("rkey").distinct().withColumn("toks", _tokens("rkey"))
    best = similar(left, right, threshold).join(named, "rkey").groupBy("lkey").agg(F.max(F.struct("jaccard", (-F.col("id")).alias("minus"))).alias("b"))
    per_text = cut.join(best, "lkey", "left").groupBy("_text").agg(F.max("b").alias("b"))
    out = rows.join(per_text, F.col("_value") == F.col("_text"))
    return out.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.coalesce(-F.col("b.minus"), F.lit(-1)).cast("long").alias(label_id), F.col("b.jaccard").alias("jaccard"))
