"""Rule-based labelling: exact match, then the longest contained token."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.functions.text import all_english, first_field, json_map, normalized, similarity
from harvestry.session import stored

def parse_language_rules(lines: DataFrame, line: str = "value", order: str = "ord") -> DataFrame:
    """``lhs, code, ord`` of lines ``lhs -> CODE [note]``; of a repeated left side the last line wins."""
    v = F.col(line)
    parts = lines.where(v.contains("->")).select(F.trim(F.split_part(v, F.lit("->"), F.lit(1))).alias("lhs"), F.regexp_extract(F.regexp_extract(v, r"->(.*)$", 1), r"^\s*(\S+)", 1).alias("code"), F.col(order).alias("ord"))
    return parts.groupBy("lhs").agg(F.max_by("code", "ord").alias("code"), F.max("ord").alias("ord"))


def parse_type_rules(lines: DataFrame, line: str = "value", order: str = "ord") -> DataFrame:
    """``token, label, values, ord`` of lines ``[[X]] token -> label : ["value", ...]``; a broken list is empty."""
    v = F.regexp_replace(F.trim(F.col(line)), r"^(\[\[[^\]]*\]\] )+", "")
    right = F.regexp_extract(v, r"->(.*)$", 1)
    rows = lines.where(v.contains("->")).select(
        F.trim(F.split_part(v, F.lit("->"), F.lit(1))).alias("token"), F.trim(F.regexp_extract(right, r"^(.*?)( : .*)?$", 1)).alias("label"),
        F.coalesce(F.from_json(F.trim(F.regexp_extract(right, r" : (.*)$", 1)), "array<string>"), F.array().cast("array<string>")).alias("values"), F.col(order).alias("ord"),
    )
    return rows.groupBy("token").agg(F.max_by(F.struct("label", "values"), "ord").alias("b"), F.max("ord").alias("ord")).select("token", "b.label", "b.values", "ord")


def parse_lint_lines(lines: DataFrame, line: str = "value", order: str = "ord") -> DataFrame:
    """``line, token, target, marked`` of well-formed rule lines with at least one value."""
    v = F.regexp_replace(F.trim(F.col(line)), r"^(\[\[[^\]]*\]\] )+", "")
    shape = r"^([^-]+?)\s*->\s*([^:]+?)\s*:\s*\[(.+)\]$"
    return lines.where(v.rlike(shape)).select(F.col(order).alias("line"), F.regexp_extract(v, shape, 1).alias("token"), F.regexp_extract(v, shape, 2).alias("target"), F.trim(F.col(line)).startswith("[[").alias("marked"))


def match_rules(values: DataFrame, value: str, rules: DataFrame, both_ways: bool, first_wins: bool) -> DataFrame:
    """``value, label`` of distinct values: exact rule, else the longest token contained (or containing, ``both_ways``).

    ``rules(token, label, ord)`` are normalised tokens. Only distinct values meet rules, and only those of which one can
    contain the other: the letters of the shorter text's three-letter pieces all stand in the longer one, so texts are
    joined on the rarest piece of the contained text and then verified; texts of fewer than three letters have few
    forms and are joined on their own pieces. Nothing is compared with everything, whatever the number of rules.
    """
    distinct, _ = stored(values.select(F.col(value).alias("_raw")).distinct().withColumn("_norm", normalized("_raw")), "distinct")
    rules, _ = stored(rules, "rules")
    exact = rules.groupBy(F.col("token").alias("_norm")).agg((F.min_by if first_wins else F.max_by)("label", "ord").alias("exact"))
    norms, tokens = distinct.select("_norm").distinct(), rules.select("token").distinct()
    pairs = _containing(norms.withColumnRenamed("_norm", "long"), tokens.withColumnRenamed("token", "short")).select(F.col("long").alias("_norm"), F.col("short").alias("token"))
    if both_ways:
        turned = _containing(tokens.withColumnRenamed("token", "long"), norms.withColumnRenamed("_norm", "short"))
        pairs = pairs.unionByName(turned.select(F.col("short").alias("_norm"), F.col("long").alias("token"))).distinct()
    near = pairs.join(rules, "token").groupBy("_norm").agg(F.min_by("label", F.struct(-F.length("token"), "ord")).alias("near"))
    return distinct.join(exact, "_norm", "left").join(near, "_norm", "left").select(F.col("_raw").alias(value), F.col("_norm"), F.coalesce("exact", "near").alias("label"))


def _pieces(text: Column, size: int) -> Column:
    """All distinct pieces of ``size`` letters; none of a shorter text."""
    starts = F.when(F.length(text) >= size, F.sequence(F.lit(1), F.length(text) - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.array_distinct(F.transform(starts, lambda i: F.substr(text, i, F.lit(size))))


def _containing(longs: DataFrame, shorts: DataFrame) -> DataFrame:
    """``long, short``: every pair of which the one text contains the other, non-empty one.

    A text of three letters or more is looked for by its rarest piece among the longer texts (if one of its pieces is in none
    of them, it is in none either), a shorter one by itself.
    """
    keys = longs.select("long", F.explode(F.concat(*[_pieces(F.col("long"), k) for k in (3, 2, 1)])).alias("piece"))
    known = keys.groupBy("piece").agg(F.count(F.lit(1)).alias("n"))
    own = F.when(F.length("short") >= 3, _pieces(F.col("short"), 3)).otherwise(F.array("short"))
    flat = shorts.where(F.col("short") != "").select("short", F.explode(own).alias("piece"))
    rarest = flat.join(known, "piece", "left").groupBy("short").agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "piece")).alias("r"))
    asked = rarest.where("r.n > 0").select("short", F.col("r.piece").alias("piece"))
    return keys.join(asked, "piece").where(F.col("long").contains(F.col("short"))).select("long", "short")


def fields(text: Column) -> dict[str, Column]:
    """Language, type and title of a metadata text, Greek names first."""
    m = json_map(text)
    return {"language": first_field(m, "Γλώσσα", "Language", "language"), "type": first_field(m, "Τύπος", "Type", "type"), "title": first_field(m, "Τίτλος", "Title", "title")}


def label_records(df: DataFrame, text: str, language_rules: DataFrame, type_rules: DataFrame) -> DataFrame:
    """``df`` with ``language_code``, ``type`` and ``title_all_english`` in place of its own of these names.

    Empty language is NONE and no rule OTHER; empty type or no rule is NA. Rules are ``(token, label, ord)``.
    """
    f = fields(F.col(text))
    base = df.drop("language_code", "type", "title_all_english").withColumn("_lang", f["language"]).withColumn("_type", f["type"]).withColumn("title_all_english", all_english(f["title"]))
    langs = match_rules(base, "_lang", language_rules, False, False).select("_lang", F.when(F.col("_norm") == "", "NONE").otherwise(F.coalesce("label", F.lit("OTHER"))).alias("language_code"))
    types = match_rules(base, "_type", type_rules, True, True).select("_type", F.when(F.col("_norm") == "", "NA").otherwise(F.coalesce("label", F.lit("NA"))).alias("type"))
    return base.join(langs, "_lang").join(types, "_type").drop("_lang", "_type")


def near_tokens(rules: DataFrame) -> DataFrame:
    """``a, b, d``: pairs of tokens (a before b) with one or two edits. Words that near share a length band, so only those meet."""
    a = rules.select(F.col("token").alias("a"), F.length("token").alias("la")).distinct()
    b = rules.select(F.col("token").alias("b"), F.explode(F.sequence(F.length("token") - 2, F.length("token") + 2)).alias("la")).distinct()
    return a.join(b, "la").where(F.col("a") < F.col("b")).withColumn("d", F.levenshtein("a", "b", 2)).where(F.col("d").between(1, 2)).select("a", "b", F.col("d").cast("long").alias("d"))


def lint(rules: DataFrame) -> DataFrame:
    """``section, a, b, value`` of rules ``(line, token, target, marked)``: repeated tokens and repeated targets with their lines,
    near tokens, targets that differ only in case or accents, totals, token lengths, and of the unmarked rules the tokens of
    at most two letters and those that don't look like their target."""
    none = F.lit(None).cast("string")
    lines = F.array_join(F.transform(F.array_sort(F.collect_list("line")), lambda v: v.cast("string")), ",")
    tok = rules.groupBy("token").agg(F.count(F.lit(1)).alias("n"), lines.alias("l")).where("n > 1").select(F.lit("repeated token").alias("section"), F.col("token").alias("a"), F.col("l").alias("b"), F.col("n").cast("long").alias("value"))
    tgt = rules.groupBy("target").agg(F.count(F.lit(1)).alias("n"), lines.alias("l")).where("n > 1").select(F.lit("repeated target"), "target", "l", F.col("n").cast("long"))
    near = near_tokens(rules).select(F.lit("near tokens"), "a", "b", "d")
    targets = rules.select("target").distinct().withColumn("norm", normalized("target"))
    alike = targets.alias("x").join(targets.alias("y"), F.col("x.norm") == F.col("y.norm")).where(F.col("x.target") < F.col("y.target")).select(F.lit("alike targets"), "x.target", "y.target", F.lit(None).cast("long"))
    totals = rules.agg(F.count(F.lit(1)).alias("rules"), F.count_distinct("token").alias("tokens"), F.count_distinct("target").alias("targets"), F.count_if("marked").alias("marked"))
    stats = totals.select(F.inline(F.array(*[F.struct(F.lit("total").alias("section"), F.lit(n).alias("a"), none.alias("b"), F.col(n).cast("long").alias("value")) for n in ("rules", "tokens", "targets", "marked")])))
    sizes = rules.groupBy(F.length("token").alias("k")).agg(F.count(F.lit(1)).alias("n")).select(F.lit("token length"), F.col("k").cast("string"), none, F.col("n").cast("long"))
    open_ = rules.where(~F.col("marked"))
    short = open_.where(F.length("token") <= 2).select(F.lit("short token"), "token", "target", F.col("line").cast("long"))
    a, b = F.lower("token"), F.lower("target")
    off = open_.where(~a.contains(b) & ~b.contains(a)).withColumn("r", similarity("token", "target")).where("r < 0.5").select(F.lit("unlike target"), "token", "target", F.col("line").cast("long"))
    out = tok
    for part in (tgt, near, alike, stats, sizes, short, off):
        out = out.union(part)
    return out


def rewrite_rules(lines: DataFrame, edits: DataFrame, line: str = "value", order: str = "ord") -> DataFrame:
    """The rule lines after a table of edits ``(step, action, line, prefix, text)``: all columns of ``lines``, none lost or added.

    ``merge``: the values of the line numbered ``text`` are added to the list of the line ``line``, each once. Of the other edits
    the first by ``step`` whose ``prefix`` the line begins with, or whose ``line`` it is, is made: ``relabel`` puts ``text`` in
    place of the prefix, ``mark`` puts ``text`` before the line unless it begins with it. Edits are a configuration and sent
    to all tasks. A list that isn't JSON is left as it is.
    """
    listed = F.from_json(F.regexp_extract(F.col(line), r"(\[[^\[\]]*\])\s*$", 1), "array<string>")
    values = lines.select(F.col(order).alias("_at"), listed.alias("_more"))
    merges = F.broadcast(edits.where("action = 'merge'").select(F.col("line").alias("_into"), F.col("text").try_cast("bigint").alias("_from")))
    extra = values.join(merges, F.col("_at") == F.col("_from")).groupBy("_into").agg(F.array_distinct(F.flatten(F.collect_list("_more"))).alias("_add"))
    j = lines.join(extra, F.col(order) == F.col("_into"), "left")
    added = F.array_union(listed, "_add")
    text = F.concat(F.regexp_extract(F.col(line), r"(?s)^(.*?)\[[^\[\]]*\]\s*$", 1), F.concat(F.lit("["), F.array_join(F.transform(added, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1)), ", "), F.lit("]")))
    j = j.withColumn("_line", F.when(F.col("_add").isNotNull() & listed.isNotNull(), text).otherwise(F.col(line)))
    steps = F.broadcast(edits.where("action <> 'merge'").agg(F.array_sort(F.collect_list(F.struct("step", "action", "line", "prefix", "text"))).alias("_steps")))  # one row
    fits = F.filter("_steps", lambda e: F.coalesce(F.col("_line").startswith(e["prefix"]), F.lit(False)) | F.coalesce(e["line"] == F.col(order), F.lit(False)))
    j = j.join(steps, F.lit(True)).withColumn("_edit", F.get(fits, F.lit(0)))
    e = F.col("_edit")
    done = F.when(e["action"] == "relabel", F.concat(e["text"], F.expr("substr(_line, length(_edit.prefix) + 1)"))).when((e["action"] == "mark") & ~F.col("_line").startswith(e["text"]), F.concat(e["text"], F.lit(" "), F.col("_line"))).otherwise(F.col("_line"))
    return j.withColumn(line, done).select(*lines.columns)
