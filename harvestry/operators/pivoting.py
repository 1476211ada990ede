"""Attribute-value records into one wide, typed row per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestry.session import stored

#: Closes the wrapper array; a document that ends early never reaches it.
_GUARD = "\u0001end"
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "allowUnquotedFieldNames": "false", "allowComments": "false"}
#: What depositors write where they have nothing to say.
NOTHING = ["-", "--", "—", "?", "??", "???", "n/a", "N/A", "na", "none", "null", "χ.αρ.", "δ.υ.", "άγνωστο", "δεν δηλώθηκε"]
#: Greek month names, in the genitive, by the first three letters without accents.
MONTHS = ["ιαν", "φεβ", "μαρ", "απρ", "μαι", "ιουν", "ιουλ", "αυγ", "σεπ", "οκτ", "νοε", "δεκ"]
#: How depositors write yes and no, without accents.
BLANKS = " \t\n\r\u00a0\u2007\u202f\u2009\u3000"
YES, NO = ["ναι", "nai", "yes", "true", "1"], ["οχι", "oxi", "ochi", "no", "false", "0"]
TYPES = ["boolean", "date", "bytes", "minutes", "scale", "decimal", "count", "string"]
#: How every typed reading but yes and no begins. A text that doesn't begin so and is longer than all listed words is text.
READABLE, LISTED = r"(?i)^(?:-?\d|pt\d|(?:[ivxlc]+, ?)?(?:[σp]\. ?)?\d)", max(map(len, [*NOTHING, *YES, *NO]))
KIND_SQL = {"boolean": "boolean", "date": "date", "bytes": "bigint", "minutes": "double", "scale": "bigint", "decimal": "double", "count": "bigint", "string": "string"}


def object_map(text: Column) -> Column:
    """``map<string,string>`` of one complete JSON object, else null; repeated names stay as repeated entries.

    The text is parsed inside an array that ends with a guard object, so trailing text, a second value or a cut-off
    object never parse as one object. Nested values stay as their JSON text, JSON null becomes null.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(',{"' + "\\u0001end" + '":"1"}]'))
    both = F.from_json(wrapped, "array<map<string,string>>", _STRICT)
    whole = (F.size(both) == 2) & F.map_contains_key(F.get(both, F.lit(1)), F.lit(_GUARD))
    return F.when(whole, F.get(both, F.lit(0)))


def has_value(value: Column) -> Column:
    """Neither null nor empty nor only white space (no-break spaces included)."""
    return value.isNotNull() & value.rlike(r"(?U)\S")


def fields_of(df: DataFrame, text: str) -> DataFrame:
    """All columns of ``df`` but ``text``, with ``_rid`` (tells rows apart, also repeated ones) and the lists ``_names`` and
    ``_values`` of the record's fields that carry a value, in order; both are empty for a record without any."""
    entries = F.filter(F.map_entries(object_map(F.col(text))), lambda e: has_value(e["value"]))
    out = df.withColumn("_rid", F.monotonically_increasing_id()).withColumn("_entries", F.coalesce(entries, F.array().cast("array<struct<key:string,value:string>>"))).drop(text)
    return out.withColumn("_names", F.col("_entries.key")).withColumn("_values", F.col("_entries.value")).drop("_entries")


def explode_fields(fields: DataFrame) -> DataFrame:
    """Entity-attribute-value rows of ``fields_of``: its other columns, ``_pos``, ``_name``, ``_value`` and ``_first``, which marks
    the first entry of a name. A record without fields keeps one row with null name."""
    out = fields.select("*", F.posexplode_outer(F.arrays_zip("_names", "_values")).alias("_pos", "_e"))
    first = F.array_position("_names", F.col("_e._names")) == F.col("_pos") + 1
    return out.withColumn("_name", F.col("_e._names")).withColumn("_value", F.col("_e._values")).withColumn("_first", first).drop("_names", "_values", "_e")


def _may_read(value: Column) -> Column:
    return value.rlike(READABLE) | (F.length(value) <= LISTED)


def _staged(df: DataFrame) -> DataFrame:
    """Adds ``_t`` (trimmed value, null if it says nothing), ``_low`` and ``_plain`` as columns of their own, so that
    each is computed once per value, and ``_typed``: whether the value can be anything but text."""
    df = df.withColumn("_t", F.trim("_value", F.lit(BLANKS)))
    df = df.withColumn("_low", F.when(_may_read(F.col("_t")), F.lower("_t")))
    df = df.withColumn("_t", F.when(F.col("_low").isNull() | ~F.col("_low").isin([x.lower() for x in NOTHING]), F.col("_t")))
    df = df.withColumn("_plain", F.translate("_low", "άέήίόύώϊ", "αεηιουωι"))
    maybe = F.col("_low").rlike(READABLE) | F.col("_plain").isin(*YES, *NO)
    return df.withColumn("_typed", F.coalesce(maybe & F.col("_t").isNotNull(), F.lit(False)))


def _readings() -> dict[str, Column]:
    """Every typed reading of a staged value, null where the value doesn't read that way."""
    t, low, plain = F.col("_t"), F.col("_low"), F.col("_plain")
    number = F.regexp_replace(F.regexp_extract(t, r"^(\d[\d.,]*)", 1), r"[.,](?=\d{3}(\D|$))", "")
    number = F.regexp_replace(number, ",", ".").try_cast("double")
    word = F.regexp_extract(low, r"^\d[\d.,]*\s*(kb|mb|gb|bytes)$", 1)
    unit = F.when(word == "kb", 1024.0).when(word == "mb", 1024.0**2).when(word == "gb", 1024.0**3).when(word == "bytes", 1.0)
    words = F.split(plain, " ")
    month = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), F.regexp_extract(F.get(words, F.lit(1)), r"^(ιουν|ιουλ|[α-ω]{3})", 1))
    spoken = F.concat_ws("-", F.get(words, F.lit(2)), month.cast("string"), F.get(words, F.lit(0)))
    date = (
        F.when(t.rlike(r"^\d{4}-\d{2}-\d{2}(T.*)?$"), F.left(t, F.lit(10)))
        .when(t.rlike(r"^(1[5-9]|20)\d{2}$"), F.concat(t, F.lit("-01-01")))
        .when(t.rlike(r"^\d{4}-\d{2}$"), F.concat(t, F.lit("-01")))
        .when(t.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.regexp_replace(t, r"^(\d+)/(\d+)/(\d+)$", "$3-$2-$1"))
        .when(plain.rlike(r"^\d{1,2} [α-ω]+ \d{4}$"), spoken)
    )
    clock = F.split(t, ":")
    part = lambda i: F.get(clock, F.lit(i)).try_cast("double")
    minutes = (
        F.when(t.rlike(r"^\d+:\d{2}:\d{2}$"), part(0) * 60 + part(1) + part(2) / 60)
        .when(t.rlike(r"^PT\d+M$"), F.regexp_extract(t, r"(\d+)", 1).try_cast("double"))
        .when(low.rlike(r"^\d+ ?(?:min|λεπτ)[^\W\d]*\.?$"), F.regexp_extract(low, r"^(\d+)", 1).try_cast("double"))
    )
    whole = r"^(?:[ivxlc]+, ?)?(?:σ\. ?|p\. ?)?0*(\d{1,15})(?: ?(?:σ\.|σελ\.|pages|τεμ\.|p\.))?$"
    return {
        "boolean": F.when(plain.isin(*YES), F.lit(True)).when(plain.isin(*NO), F.lit(False)),
        "date": F.try_to_date(date, "yyyy-M-d"),
        "bytes": F.when(unit.isNotNull(), F.round(number * unit)).cast("long"),
        "minutes": minutes,
        "scale": F.regexp_extract(t, r"^1 ?[:/] ?(\d+)$", 1).try_cast("long"),
        "decimal": F.regexp_replace(F.regexp_extract(t, r"^(-?\d+[.,]\d+)$", 1), ",", ".").try_cast("double"),
        "count": F.regexp_extract(low, whole, 1).try_cast("long"),
    }


def discover_attributes(eav: DataFrame, share: float = 0.8) -> DataFrame:
    """``name, n_records, n_values, kind, n_unread``: every attribute with its type, found over all rows.

    The type is the first of TYPES that at least ``share`` of the values saying something read as; a plain number
    in a column of sizes counts as bytes. Names without any such value are strings. ``n_unread`` counts the values
    that don't read as the type (those saying nothing among them); ``wide_records`` keeps them as text. Values are counted
    before they are read; those that no reading takes stand for each other.
    """
    kinds = _readings()
    own = F.when(_may_read(F.trim("_value", F.lit(BLANKS))), F.col("_value")).otherwise(F.lit("a text of many words that no reading takes"))
    seen = eav.where(F.col("_name").isNotNull()).groupBy("_name", own.alias("_value")).agg(F.sum(F.col("_first").cast("long")).alias("f"), F.count(F.lit(1)).alias("n"))
    flags = [F.when(F.col("_typed") & r.isNotNull(), F.col("n")).otherwise(F.lit(0)).alias(k) for k, r in kinds.items()]
    rows = _staged(seen).select("_name", "f", "n", F.when(F.col("_t").isNotNull(), F.col("n")).otherwise(F.lit(0)).alias("string"), *flags)
    sums = rows.groupBy(F.col("_name").alias("name")).agg(F.sum("f").alias("n_records"), F.sum("n").alias("n_values"), *[F.sum(k).alias(k) for k in TYPES])
    enough = F.col("string") * share
    kind, read = F.lit("string"), F.col("n_values")
    for k in reversed(TYPES[:-1]):
        got = F.col("bytes") + F.col("count") if k == "bytes" else F.col("minutes") + F.col("count") if k == "minutes" else F.col(k)
        need = (F.col("string") > 0) & (got >= enough) & (F.col(k) * 4 >= F.col("string"))
        kind, read = F.when(need, F.lit(k)).otherwise(kind), F.when(need, got).otherwise(read)
    return sums.select("name", "n_records", "n_values", kind.alias("kind"), (F.col("n_values") - read).alias("n_unread"))


#: Bits used of a number that marks entries.
WORD = 62
_SOURCE = {"bigint": "_long", "double": "_double", "boolean": "_bool", "date": "_date"}


def _read(eav: DataFrame, kind: Column) -> DataFrame:
    """Adds ``_kind``, one column per storage type with the value as its attribute's kind reads it, and ``_reads``."""
    r = _readings()
    eav = _staged(eav).withColumn("_kind", F.coalesce(kind, F.lit("string")))
    is_ = lambda k: F.col("_typed") & (F.col("_kind") == k)
    whole = F.when(is_("bytes"), F.coalesce(r["bytes"], r["count"])).when(is_("scale"), r["scale"]).when(is_("count"), r["count"])
    real = F.when(is_("minutes"), F.coalesce(r["minutes"], r["count"].cast("double"))).when(is_("decimal"), r["decimal"])
    own = [c for c in eav.columns if c not in ("_t", "_low", "_plain", "_typed")]
    eav = eav.select(*own, whole.alias("_long"), real.alias("_double"), F.when(is_("boolean"), r["boolean"]).alias("_bool"), F.when(is_("date"), r["date"]).alias("_date"))
    return eav.withColumn("_reads", (F.col("_kind") == "string") | F.col("_long").isNotNull() | F.col("_double").isNotNull() | F.col("_bool").isNotNull() | F.col("_date").isNotNull())


def _pivoted(fields: DataFrame, listed: list, record_id: str, stated: str | None, words: int = 0) -> DataFrame:
    """One row per ``_rid``: per listed attribute the typed value (``_a<i>``; for text its place ``_p<i>``) of the last entry
    that reads, and the place of the last that doesn't (``_u<i>``); ``_more`` names beyond the list; ``n_fields``, counted
    from these; and the places of all entries that don't read as bits of ``words`` numbers (``_w<k>``). All states have a
    fixed width, so they are aggregated in hash tables, in part before the shuffle."""
    code = F.create_map(*[F.lit(x) for i, a in enumerate(listed) for x in (a["name"], i)]) if listed else F.create_map().cast("map<string,int>")
    kinds = F.array(*[F.lit(a["kind"]) for a in listed]) if listed else F.array().cast("array<string>")
    eav = explode_fields(fields).withColumn("_i", F.try_element_at(code, F.col("_name")))
    eav = _read(eav, F.get(kinds, F.col("_i")))
    aggs = [F.first(record_id).alias("_id"), *([F.first(stated).alias("_stated")] if stated else []), F.count_if(F.col("_i").isNull() & F.col("_first")).alias("_more")]
    held = []
    for i, a in enumerate(listed):
        mine = F.col("_i") == i
        if a["kind"] == "string":
            aggs.append(F.max(F.when(mine, F.col("_pos"))).alias(f"_p{i}"))
            held.append(F.col(f"_p{i}").isNotNull())
        else:
            aggs += [F.max_by(F.col(_SOURCE[KIND_SQL[a["kind"]]]), F.when(mine & F.col("_reads"), F.col("_pos"))).alias(f"_a{i}"), F.max(F.when(mine & ~F.col("_reads"), F.col("_pos"))).alias(f"_u{i}")]
            held.append(F.col(f"_a{i}").isNotNull() | F.col(f"_u{i}").isNotNull())
    off = F.col("_name").isNotNull() & ~F.col("_reads")
    for k in range(words):
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("_pos") - k * WORD)
        aggs.append(F.bit_or(F.when(off & F.col("_pos").between(k * WORD, k * WORD + WORD - 1), bit)).alias(f"_w{k}"))
    rows = eav.groupBy("_rid").agg(*aggs)
    n = F.col("_more")
    for h in held:
        n = n + h.cast("long")
    return rows.withColumn("n_fields", n)


def _setup(df: DataFrame, record_id: str, text: str, stated: str | None, max_columns: int) -> tuple[DataFrame, list, bool]:
    """(fields, stored once; the listed attributes, most frequent first; whether there are more)."""
    fields, _ = stored(fields_of(df.select(record_id, text, *([stated] if stated else [])), text), "fields")
    listed = discover_attributes(explode_fields(fields)).orderBy(F.desc("n_records"), "name").limit(max_columns + 1).collect()  # bounded by max_columns
    return fields, listed[:max_columns], len(listed) > max_columns


def _matches(stated: str | None) -> list[Column]:
    return [F.col("_stated").alias("n_stated"), F.coalesce(F.col("_stated") == F.col("n_fields"), F.lit(False)).alias("count_matches")] if stated else []


def field_counts(df: DataFrame, record_id: str, text: str, stated: str | None = None, max_columns: int = 500) -> DataFrame:
    """``record_id, n_fields, n_stated, count_matches`` of ``wide_records``, counted from its pivoted columns; the texts of
    the columns aren't fetched."""
    fields, listed, _ = _setup(df, record_id, text, stated, max_columns)
    return _pivoted(fields, listed, record_id, stated).select(F.col("_id").alias(record_id), "n_fields", *_matches(stated))


def wide_records(df: DataFrame, record_id: str, text: str, stated: str | None = None, max_columns: int = 500) -> DataFrame:
    """One row per record of ``df`` with a typed column per attribute, ``n_fields``, ``n_stated``, ``count_matches`` and ``unread_fields``.

    The attribute list and types are discovered first; then one conditional aggregation per attribute fills the
    columns. Of a name that a record holds more than once, the last entry that reads as the attribute's type wins.
    Values that don't read so are kept as they were written, all of them and in order, in the map ``unread_fields``
    (name to texts; ``discover_attributes`` counts them per attribute). A table can't have a column for each of any number
    of attributes: those beyond the ``max_columns`` most frequent ones go to the map ``other_fields``, typed all the same:
    name to its kind, the value as that kind reads it (``whole``, ``real``, ``yes`` or ``day``) and its text, by the same rules.
    So every name that ``n_fields`` counts has a value in its column or in one of the maps. A column that would clash with
    another (or differ only in case) gets a number. Null, broken or non-object text gives a row of nulls with ``n_fields``
    0; an empty table gives no rows.
    """
    fields, listed, extra = _setup(df, record_id, text, stated, max_columns)
    taken = {c.lower() for c in (record_id, "n_fields", "n_stated", "count_matches", "unread_fields", "other_fields")}
    labels = []
    for a in listed:
        label, k = a["name"], 2
        while label.lower() in taken:
            label, k = f"{a['name']}_{k}", k + 1
        taken.add(label.lower())
        labels.append(label)
    longest = fields.agg(F.max(F.size("_names"))).first()[0] or 0
    words = -(-longest // WORD)
    rows = _pivoted(fields, listed, record_id, stated, words)
    rows = rows.join(fields.select(F.col("_rid").alias("_own"), "_names", "_values"), F.col("_rid") == F.col("_own"))
    text_map = "map<string,array<string>>"
    none = F.create_map().cast(text_map)
    if words:
        marks = F.array(*[F.coalesce(f"_w{k}", F.lit(0).cast("long")) for k in range(words)])
        marked = lambda i: F.call_function("shiftrightunsigned", F.get(marks, (i / WORD).cast("int")), (i % WORD).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1
        places = F.filter(F.sequence(F.lit(0), F.size("_names") - 1), marked)
        name_at = F.array_distinct(F.transform(places, lambda i: F.get("_names", i)))
        by_name = F.map_from_arrays(name_at, F.transform(name_at, lambda n: F.transform(F.filter(places, lambda i: F.get("_names", i) == n), lambda i: F.get("_values", i))))
        unread = F.when(F.coalesce(*[F.col(f"_w{k}") for k in range(words)]).isNull(), none).otherwise(by_name)
    else:
        unread = none
    rows = rows.withColumn("_unread", unread)
    if extra:
        # the attributes beyond the list are discovered and read the same way, and put into one map per record
        away = explode_fields(fields).where(F.col("_name").isNotNull() & ~F.col("_name").isin([a["name"] for a in listed]))
        kinds = discover_attributes(away).select(F.col("name").alias("_known"), F.col("kind").alias("_of"))
        read = _read(away.join(kinds, F.col("_name") == F.col("_known")), F.col("_of"))
        value = F.struct(F.col("_kind").alias("kind"), F.col("_long").alias("whole"), F.col("_double").alias("real"), F.col("_bool").alias("yes"), F.col("_date").alias("day"), F.col("_value").alias("text"))
        best = read.groupBy("_rid", "_name").agg(F.max_by(value, F.when(F.col("_reads"), F.col("_pos"))).alias("v"), F.array_sort(F.collect_list(F.when(~F.col("_reads"), F.struct("_pos", "_value")))).alias("no"))
        maps = best.groupBy(F.col("_rid").alias("_mine")).agg(F.map_from_entries(F.collect_list(F.when(F.col("v").isNotNull(), F.struct("_name", "v")))).alias("_other"), F.map_from_entries(F.collect_list(F.when(F.size("no") > 0, F.struct("_name", F.col("no._value"))))).alias("_off"))
        rows = rows.join(maps, F.col("_rid") == F.col("_mine"), "left").withColumn("_unread", F.map_concat("_unread", F.coalesce("_off", none)))
    out = [F.col("_id").alias(record_id), "n_fields", *_matches(stated), F.col("_unread").alias("unread_fields")]
    if extra:
        empty = F.create_map().cast("map<string,struct<kind:string,whole:bigint,real:double,yes:boolean,day:date,text:string>>")
        out.append(F.coalesce("_other", empty).alias("other_fields"))
    typed = [F.get("_values", F.col(f"_p{i}")) if a["kind"] == "string" else F.col(f"_a{i}") for i, a in enumerate(listed)]
    return rows.select(*out, *[c.alias(label) for c, label in zip(typed, labels, strict=True)])
