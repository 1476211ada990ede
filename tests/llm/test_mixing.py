import os

import pytest

from harvestry.llm import mixing
from harvestry.llm.mixing import TOKENIZER, encoding, mix, plan_mixture, token_counts

pytestmark = pytest.mark.skipif(not os.path.exists(TOKENIZER), reason="no tokenizer files")
D = "doc_id bigint, text string, source string, slot int, rank int"
T = "source string, target_share double, max_repeats bigint"


def docs(spark, n=600):
    rows = [(i, f"word number {i} " * (i % 9 + 1), ["big", "big ", "BIG", "small", "tiny", None][i % 6] if i > 5 else "tiny", 1, 2) for i in range(n)]
    return spark.createDataFrame([*rows, (n, None, "big", 1, 2), (n + 1, "", "small", 1, 2)], D)


def targets(spark):
    return spark.createDataFrame([("big", 0.5, 1), ("small", 0.3, 3), ("tiny", 0.1, 4), ("absent", 0.1, 2)], T)


def test_token_counts(spark):
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts(docs(spark), ["doc_id"]).collect()}
    for i, text, *_ in [tuple(r) for r in docs(spark).collect()]:
        assert got[i] == len(encoding(TOKENIZER).encode_ordinary(text or ""))


def test_shares_and_repeats(spark):
    mixture, report = mix(docs(spark), targets(spark))
    shares = {r["source"]: r for r in report.collect()}
    for s, goal in (("big", 0.5 / 0.9), ("small", 0.3 / 0.9), ("tiny", 0.1 / 0.9)):
        assert shares[s]["actual_share"] == pytest.approx(goal, abs=0.02)
        assert 1 <= shares[s]["repeats_used"] <= shares[s]["max_repeats"]
    assert shares["absent"]["tokens_taken"] == 0 and shares[None]["tokens_taken"] == 0 and shares[None]["n_docs"] > 0
    rows = mixture.collect()
    assert sum(r["n_tokens"] for r in rows) == sum(r["tokens_taken"] for r in shares.values())
    pieces = {}
    for r in rows:
        pieces.setdefault((r["source"], r["repeat"], r["doc_id"]), []).append((r["first_token"], r["n_tokens"]))
    assert all(a + n == b for p in pieces.values() for (a, n), (b, _) in zip(sorted(p), sorted(p)[1:], strict=False))  # no token twice per repeat
    per_slot = {}
    for r in rows:
        per_slot[r["slot"]] = per_slot.get(r["slot"], 0) + r["n_tokens"]
    assert sorted(set(per_slot.values()))[-1] == max(per_slot.values()) and sum(v == max(per_slot.values()) for v in per_slot.values()) >= len(per_slot) - 3
    # low discrepancy: every stretch of slots has about the shares
    slots = sorted({(r["slot"], r["source"]) for r in rows})
    half = [s for k, s in slots if k < slots[-1][0] // 2]
    assert half.count("big") / len(half) == pytest.approx(0.5 / 0.9, abs=0.05)


def test_targets_are_folded_and_counted_once_or_refused(spark, monkeypatch):
    twice = targets(spark).union(spark.createDataFrame([("BIG ", 0.5, 1), (None, 0.2, 1), ("small", None, None)], T))
    a, b = (sorted(mix(docs(spark), t)[1].collect(), key=repr) for t in (targets(spark), twice))
    assert a == b
    monkeypatch.setattr(mixing, "MAX_TARGETS", 3)
    with pytest.raises(ValueError, match="at most 3"):
        mix(docs(spark), targets(spark))


def test_small_ranges_repeated_and_missing_ids_change_nothing(spark, monkeypatch):
    rows = [(None if i % 3 == 0 else i % 50, "x " * (i % 7 + 1), "big" if i % 4 else "small", 1, i % 9) for i in range(400)]
    d = spark.createDataFrame(rows, D)
    whole = mix(d, targets(spark), size="rank")
    monkeypatch.setattr(mixing, "ROWS_PER_RANGE", 20)
    parts = mix(d, targets(spark), size="rank")
    assert sorted(whole[1].collect(), key=repr) == sorted(parts[1].collect(), key=repr)
    assert sum(r["n_tokens"] for r in parts[0].collect()) == sum(r["tokens_taken"] for r in parts[1].collect())


def test_plan_and_empty(spark):
    assert plan_mixture({"a": 100, "b": 10}, [("a", 0.5, 1), ("b", 0.5, 2)]) == (40, {"a": 0.5, "b": 0.5})
    assert plan_mixture({}, [("a", 1.0, 1)]) == (0, {}) and plan_mixture({"a": 5}, [("a", 1.0, None)], 3)[0] == 3
    mixture, report = mix(docs(spark).limit(0), targets(spark))
    assert mixture.count() == 0 and report.where("tokens_taken > 0").count() == 0
    mixture, report = mix(docs(spark), targets(spark).limit(0))
    assert mixture.count() == 0
