"""Mix sources to target weights: a low-discrepancy schedule over blocks of equal token counts."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from harvestry.functions.prefix import number_rows
from harvestry.session import stored

#: Where a public tokenizer's ranks are; a parameter of every function that counts tokens.
TOKENIZER = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: how this family of tokenizers splits a text into words.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_ENCODINGS: dict[str, object] = {}


def encoding(path: str):  # noqa: ANN201
    """The tokenizer of a ranks file, read once per Python worker."""
    if path not in _ENCODINGS:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODINGS[path] = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
    return _ENCODINGS[path]


def token_counts(docs: DataFrame, keep: list[str], text: str = "text", tokenizer: str = TOKENIZER) -> DataFrame:
    """``keep`` columns and ``n_tokens`` of each row's whole text (0 for null), without a shuffle."""
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.select(*keep).dtypes) + ", n_tokens bigint"

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        enc = encoding(tokenizer)
        for pdf in batches:
            pdf["n_tokens"] = [len(enc.encode_ordinary(t)) if t else 0 for t in pdf["_text"]]
            yield pdf.drop(columns="_text")

    return docs.select(*keep, F.col(text).alias("_text")).mapInPandas(count, schema)


def source_name(c: Column) -> Column:
    """One spelling per source: lower case, blanks and hyphens as underscores."""
    return F.lower(F.regexp_replace(F.trim(c), r"[\s-]+", "_"))


def plan_mixture(sizes: dict[str, int], targets: list[tuple[str, float, int]], total: int | None = None) -> tuple[int, dict[str, float]]:
    """(total tokens, share of each source that has any): the greatest total at which every source meets its share.

    Sources without a token can't contribute; their share goes to the others in proportion. ``total`` caps the sum.
    """
    live = [(s, w, max(1, r or 1)) for s, w, r in targets if sizes.get(s, 0) > 0 and (w or 0) > 0]
    weight = sum(w for _, w, _ in live)
    if not live:
        return 0, {}
    most = min(r * sizes[s] * weight / w for s, w, r in live)
    return int(min(most, total) if total else most), {s: w / weight for s, w, _ in live}


#: Sources of a plan: targets are a configuration and come to the driver; more than this is an error.
MAX_TARGETS = 10_000
#: Slots and documents that one task ranks at a time; the number of tasks grows with them.
ROWS_PER_RANGE = 500_000


def mix(docs: DataFrame, targets: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", block_tokens: int = 8192, total: int | None = None, seed: int = 7, tokenizer: str = TOKENIZER, size: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares). Mixture: ``slot, source, repeat, doc_id, first_token, n_tokens``, to be read in slot order.

    The documents of a source are shuffled by a keyed hash and laid end to end, as often as the source may repeat; this
    line of tokens is cut into blocks of exactly ``block_tokens`` tokens, so a document may span blocks: ``first_token`` is
    the place in the document where the piece of ``n_tokens`` tokens begins. Slot i takes the van der Corput point of i
    through the cumulative weights, which names its source; the slots of a source are ranked, and rank r takes block r, so
    every slot holds the same number of tokens and no source is taken more than ``max_repeats`` times. Running token counts
    and ranks are prefix sums over ranges of hashes and slots, whose number grows with the table, so a source with most
    documents is never in one task.

    Source names are folded on both sides (``source_name``); a target named more than once counts once, with its largest
    share and repeats; a null or absent ``max_repeats`` is 1. ``size`` names a column to be taken for the number of tokens.
    Shares: ``source, target_share, max_repeats, n_docs, n_tokens, tokens_taken, repeats_used, actual_share`` of every target
    and every other source; documents without a source are a row with null source. Empty tables give an empty mixture and
    shares of 0. Documents without tokens take no place. More than MAX_TARGETS targets raise a ValueError.
    """
    spark = docs.sparkSession
    own = [F.col(doc_id).alias("doc_id"), source_name(F.col(source)).alias("source")]
    if size:
        rows = docs.select(*own, F.coalesce(F.col(size).cast("long"), F.lit(0).cast("long")).alias("n_tokens"))
    else:
        rows = token_counts(docs.select(*own, F.col(text).alias("_t")), ["doc_id", "source"], "_t", tokenizer)
    counted, _ = stored(rows.withColumn("_n", F.monotonically_increasing_id()), "tokens")
    goal = targets.where(F.col("source").isNotNull()).groupBy(source_name(F.col("source")).alias("source")).agg(F.max("target_share").cast("double").alias("target_share"), F.max("max_repeats").cast("long").alias("max_repeats"))
    plan = goal.limit(MAX_TARGETS + 1).collect()
    if len(plan) > MAX_TARGETS:
        raise ValueError(f"a plan has at most {MAX_TARGETS} sources")
    have = counted.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_tokens").alias("n_tokens"), F.count_if(F.col("n_tokens") > 0).alias("n_full"))
    held = {r["source"]: r for r in have.join(F.broadcast(goal.select("source")), "source", "left_semi").collect()}  # at most a row per target
    sizes = {s: r["n_tokens"] for s, r in held.items()}
    tokens, shares = plan_mixture(sizes, [(r["source"], r["target_share"] or 0.0, r["max_repeats"] or 1) for r in plan], total)
    names = sorted(shares)
    repeats = {r["source"]: max(1, r["max_repeats"] or 1) for r in plan}
    block_tokens = max(1, min(block_tokens, tokens // 2000 or 1))
    slots_n = tokens // block_tokens
    lookup = lambda values, kind: F.try_element_at(F.create_map(*[x for s in names for x in (F.lit(s), F.lit(values[s]))]).cast(f"map<string,{kind}>") if names else F.create_map().cast(f"map<string,{kind}>"), F.col("source"))

    # the documents of each source end to end, in the order of a keyed hash; a missing id is told apart by the row's number
    h = F.when(F.col("doc_id").isNull(), F.xxhash64(F.lit(seed), "_n")).otherwise(F.xxhash64(F.lit(seed), "doc_id"))
    bits_of = max(3, (sum(r["n_full"] for r in held.values()) // ROWS_PER_RANGE).bit_length() + 3)
    known = counted.where(F.col("source").isin(names) & (F.col("n_tokens") > 0)) if names else counted.limit(0)
    placed = number_rows(known.withColumn("_h", h).withColumn("_range", F.shiftright("_h", 64 - bits_of)), "source", ["_h", "_n"], "_range", "_start", weight="n_tokens")
    round_ = placed.withColumn("repeat", F.explode(F.sequence(F.lit(0).cast("long"), lookup(repeats, "bigint") - 1)))
    from_ = F.col("repeat") * lookup(sizes, "bigint") + F.col("_start")
    pieces = round_.withColumn("_from", from_).withColumn("block", F.explode(F.sequence(F.floor(F.col("_from") / block_tokens), F.floor((F.col("_from") + F.col("n_tokens") - 1) / block_tokens))))
    first = F.greatest(F.lit(0).cast("long"), F.col("block") * block_tokens - F.col("_from"))
    end = F.least(F.col("n_tokens"), (F.col("block") + 1) * block_tokens - F.col("_from"))
    pieces = pieces.select("source", "block", "repeat", "doc_id", first.alias("first_token"), (end - first).alias("n_tokens"))

    # slots
    bits = max(1, int(slots_n).bit_length())
    turned = F.conv(F.reverse(F.lpad(F.bin("slot"), bits, "0")), 2, 10).cast("double")
    cumulative, running = [], 0.0
    for s in names:
        running += shares[s]
        cumulative.append(running)
    at = F.size(F.filter(F.array(*[F.lit(float(c)) for c in cumulative[:-1]]).cast("array<double>"), lambda c: c <= F.col("u"))) + 1
    slots = spark.range(slots_n).withColumnRenamed("id", "slot").withColumn("u", (turned + 0.5) / float(1 << bits))
    slots = slots.withColumn("source", F.element_at(F.array(*[F.lit(s) for s in names]) if names else F.array(F.lit(None).cast("string")), at.cast("int")))
    ranked = number_rows(slots.select("slot", "source", F.floor(F.col("slot") / ROWS_PER_RANGE).alias("_range")), "source", "slot", "_range", "block")
    mixture = ranked.select("slot", "source", "block").join(pieces, ["source", "block"]).select("slot", "source", "repeat", "doc_id", "first_token", "n_tokens")

    used = mixture.groupBy(F.col("source").alias("_s")).agg(F.sum("n_tokens").alias("tokens_taken"), (F.max("repeat") + 1).alias("repeats_used"))
    report = have.join(goal.withColumnRenamed("source", "_g"), F.col("source").eqNullSafe(F.col("_g")), "full_outer").withColumn("source", F.coalesce("source", "_g"))
    report = report.join(used, F.col("source") == F.col("_s"), "left")
    zero = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long").alias(c)
    report = report.select("source", "target_share", "max_repeats", zero("n_docs"), zero("n_tokens"), zero("tokens_taken"), zero("repeats_used"))
    whole = F.sum("tokens_taken").over(Window.partitionBy(F.lit(1)))  # a row per source
    return mixture, report.withColumn("actual_share", F.when(whole > 0, F.col("tokens_taken") / whole).otherwise(0.0))
