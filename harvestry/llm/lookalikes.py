"""Visually identical text brought to one form: decompose, map look-alikes, order marks, recompose."""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

#: Letters of Greek, Latin and Cyrillic that look the same; each group's first letter stands for all.
LOOKALIKES = [
    "AΑА", "BΒВ", "CС", "EΕЕ", "HΗН", "IΙІӀ", "JЈ", "KΚК", "MΜМ", "NΝ", "OΟО", "PΡР", "SЅ", "TΤТ", "XΧХ", "YΥҮ", "ZΖ", "QԚ", "WԜ", "ΓГ", "ΠП", "ΦФ", "ΛЛ",
    "aа", "cсϲ", "dԁ", "eе", "hһ", "iі", "jјϳ", "lӏ", "oοо", "pρр", "qԛ", "sѕ", "vνѵ", "wԝ", "xх", "yу", "κкĸ", "πп", "φф",
]
#: Signs that look like an ASCII sign.
SIGNS = {"-": "‐‑‒−﹣", "/": "∕⁄╱", ":": "꞉։∶ː", "'": "’ʼ‘ʹ", '"': "“”", ".": "․", ",": "‚", ";": ";", "_": "ˍ"}
#: Code points that show nothing.
INVISIBLE = "­͏؜᠎​‌‍‎‏‪‫‬‭‮⁠⁡⁢⁣⁤⁦⁧⁨⁩﻿"


#: Tasks that rows without a text are spread over.
SALTS = 4096


@lru_cache(maxsize=1)
def _tables() -> tuple[list[tuple], list[tuple]]:
    """(decomposition rows, composition rows), built from the Unicode database; bounded by its size (a few thousand).

    Decomposition: character -> [(code point, combining class, look-alike class)], empty for invisible ones.
    Characters without a row stand for themselves. Composition: decomposed cluster -> composed character.
    """
    alike = {c: g[0] for g in LOOKALIKES for c in g}
    signs = {c: a for a, cs in SIGNS.items() for c in cs}
    down, up = [], {}
    for n in range(sys.maxunicode + 1):
        c = chr(n)
        if 0xAC00 <= n <= 0xD7A3 or 0xD800 <= n <= 0xDFFF:
            continue  # Hangul syllables compose by rule and have no look-alikes here
        if c in INVISIBLE:
            down.append((c, []))
            continue
        kind = unicodedata.category(c)
        compat = unicodedata.decomposition(c).split(" ")[0]
        if kind == "Zs" or c in "\t\n\r\v\f":
            parts = " "
        elif compat in ("<wide>", "<narrow>", "<compat>", "<font>", "<noBreak>") and kind != "Sk":
            parts = unicodedata.normalize("NFKD", c)
        else:
            parts = unicodedata.normalize("NFD", c)
        seq = [(signs.get(p, p), unicodedata.combining(p), alike.get(signs.get(p, p), signs.get(p, p))) for p in parts]
        if seq != [(c, 0, c)]:
            down.append((c, seq))
        plain = unicodedata.normalize("NFD", c)
        if len(plain) > 1 and unicodedata.normalize("NFC", plain) == c:
            up[plain] = c
    return down, sorted(up.items())


@F.pandas_udf(StringType())
def _nfc(s: pd.Series) -> pd.Series:
    return s.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


def one_form(df: DataFrame, text: str) -> DataFrame:
    """Distinct values of ``text`` (nulls left out) with ``canonical`` and ``skeleton``: columns ``_text, canonical, skeleton``.

    Each distinct text is exploded to positioned code points; a broadcast join (size bounded by Unicode) replaces every
    code point by its decomposition, drops invisible ones and turns every kind of blank into a space; combining marks are
    ordered by class behind their base; each cluster is recomposed and the strings are rebuilt. ``canonical`` keeps the
    script, ``skeleton`` also maps look-alike letters to one letter each. Case, accents and marks are kept in both;
    blanks at either end are dropped. The empty text gives empty strings. Repeated texts come out once.
    """
    spark = df.sparkSession
    down, up = _tables()
    down_df = spark.createDataFrame(down, "c string, seq array<struct<p:string,ccc:int,s:string>>")
    up_df = spark.createDataFrame(up, "cluster string, composed string")
    texts = df.where(F.col(text).isNotNull()).groupBy(F.col(text).alias("_text")).agg(F.lit(1).alias("_1")).select("_text", F.xxhash64(F.lit(1), "_text").alias("h1"), F.xxhash64(F.lit(2), "_text").alias("h2"))
    points = texts.select("h1", "h2", F.posexplode(F.split("_text", "")).alias("pos", "c")).where(F.col("c") != "")
    mapped = points.join(F.broadcast(down_df), "c", "left")
    own = F.array(F.struct(F.col("c").alias("p"), F.lit(0).alias("ccc"), F.col("c").alias("s")))
    parts = mapped.select("h1", "h2", "pos", F.posexplode(F.coalesce("seq", own)).alias("sub", "x")).select("h1", "h2", "pos", "sub", "x.p", "x.ccc", "x.s")
    line = Window.partitionBy("h1", "h2").orderBy("pos", "sub").rowsBetween(Window.unboundedPreceding, 0)
    starters = parts.withColumn("base", F.sum(F.when(F.col("ccc") == 0, 1).otherwise(0)).over(line))
    marks = F.array_sort(F.collect_list(F.struct("ccc", "pos", "sub", "p", "s")))
    clusters = starters.groupBy("h1", "h2", "base").agg(marks.alias("m"))
    joined = lambda k: F.array_join(F.transform("m", lambda x: x[k]), "")
    clusters = clusters.select("h1", "h2", "base", joined("p").alias("p"), joined("s").alias("s"))
    up_s = up_df.select(F.col("cluster").alias("cs"), F.col("composed").alias("ds"))
    recomposed = clusters.join(F.broadcast(up_df), F.col("p") == F.col("cluster"), "left").join(F.broadcast(up_s), F.col("s") == F.col("cs"), "left")
    # a cluster that composes only in part isn't in the table: such texts, and only they, are composed mark by mark
    odd = ((F.length("p") > 1) & F.col("composed").isNull()) | ((F.length("s") > 1) & F.col("ds").isNull())
    rebuilt = recomposed.groupBy("h1", "h2").agg(F.max(odd).alias("odd"), F.array_sort(F.collect_list(F.struct("base", F.coalesce("composed", "p").alias("p"), F.coalesce("ds", "s").alias("s")))).alias("m"))
    rebuilt = rebuilt.select("h1", "h2", "odd", F.trim(joined("p")).alias("canonical"), F.trim(joined("s")).alias("skeleton"))
    whole = lambda c: F.coalesce(_nfc(F.when(F.col("odd"), F.col(c))), F.col(c)).alias(c)
    rebuilt = rebuilt.select("h1", "h2", whole("canonical"), whole("skeleton"))
    out = texts.join(rebuilt, ["h1", "h2"], "left")
    return out.select("_text", F.coalesce("canonical", F.lit("")).alias("canonical"), F.coalesce("skeleton", F.lit("")).alias("skeleton"))


def unify(df: DataFrame, text: str, values: DataFrame, value_id: str, value: str, keep: list[str]) -> DataFrame:
    """``keep`` columns of every row of ``df`` with ``value_id`` and ``unified``: the known spelling its text looks like.

    Known spellings go through the same operator, and texts are joined to them by skeleton; where several spellings
    look alike the smallest id wins. A text that looks like none keeps its own canonical form and a null id; null text
    stays null.
    """
    known = one_form(values, value).join(values.select(F.col(value).alias("_text"), F.col(value_id).alias("_vid")), "_text")
    known = known.groupBy("skeleton").agg(F.min(F.struct("_vid", "_text")).alias("k"))
    forms = one_form(df, text).join(known, "skeleton", "left")
    forms = forms.select("_text", F.col("k._vid").alias("_vid"), F.coalesce("k._text", "canonical").alias("_unified"))
    kept = [F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)]
    # rows without a text would all meet in one task of an outer join: they are spread over salts, which no form has
    salt = F.when(F.col(text).isNull(), F.pmod(F.xxhash64(*keep), F.lit(SALTS - 1)) + 1).otherwise(F.lit(0)) if keep else F.lit(0)
    rows = df.select(F.coalesce(F.col(text), F.lit("")).alias("_value"), salt.cast("int").alias("_salt"), *kept)
    forms = forms.withColumn("_zero", F.lit(0))
    joined = rows.join(forms, (F.col("_value") == F.col("_text")) & (F.col("_salt") == F.col("_zero")), "left")
    return joined.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], F.col("_vid").alias(value_id), F.col("_unified").alias("unified"))
