import random

import numpy as np
import pytest

from harvestry.llm import leaks
from harvestry.llm.leaks import FmIndex, Items, fold, scan, words_of

PASSAGE = "Στο Πυλλιμούνι, ο λιθοξόος κάτω από τη στέρνα αντέγραψε το κουρντιστήρι των πλανόδιων δίχως να το μάθει κανείς. Τάχα η πομπή του αγιογράφου φυλάκισε ένα λεξικό με τα σπασμένα βουλοκέρια όσο φυσούσε ο βοριάς"
WORDS = PASSAGE.split()


@pytest.mark.parametrize("seed", range(8))
def test_index_equals_brute_force(seed):
    rng = np.random.default_rng(seed)
    v = int(rng.integers(1, 6))
    docs = [rng.integers(0, v + 1, rng.integers(0, 40)).tolist() for _ in range(12)] + [[1] * 50, [1] * 50]
    text, starts = [], []
    for d in docs:
        starts.append(len(text))
        text += [*d, v + 1]
    index = FmIndex(np.array(text, np.int64), np.array(starts), v + 2, sample=5)
    for size in (1, 2, 4):
        phrases = rng.integers(1, v + 1, (30, size))
        lo, hi = index.search(phrases)
        for p, a, b in zip(phrases.tolist(), lo, hi, strict=True):
            want = [i for i in range(len(text)) if text[i : i + size] == p]
            assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def found(*texts, items=((1, PASSAGE),)):
    import pandas as pd

    none = pd.DataFrame({c: [] for c in ("doc_id", "item_id", "first_char", "end_char")}, dtype="int64")
    out = pd.concat([none, *scan(iter([pd.DataFrame({"doc_id": range(len(texts)), "text": list(texts)})]), Items(list(items)))])
    return {(a, b) for a, b in out[["doc_id", "item_id"]].values.tolist()}, out


def test_forms_of_a_leak():
    rng = random.Random(2)
    noise = "Η μελέτη των αρχείων δείχνει την κατανομή. " * 20
    spaced = "".join(w + rng.choice(["  ", " \t", "\n", "\r\n> "]) for w in WORDS)
    wrong = WORDS[:]
    for k in (4, 13, 22, 30):
        wrong[k] = "άλλο"
    forms = [PASSAGE, PASSAGE.upper(), words_of(PASSAGE) and " ".join(words_of(PASSAGE)), spaced, "<p>" + PASSAGE.replace(",", "</b>,") + "</p>", PASSAGE.replace("κουρντιστήρι", "κουρντι-\nστήρι"), " ".join(WORDS[7:23]), " ".join(wrong), PASSAGE.replace("αντέγραψε", "αντέ|γραψε"), " ".join(w for k, w in enumerate(WORDS) if k % 9 != 5)]
    got, out = found(*[f"{noise}{f} {noise}" for f in forms])
    assert got == {(i, 1) for i in range(len(forms))}
    whole = out[out["doc_id"] == 0].iloc[0]
    assert f"{noise}{forms[0]} {noise}"[whole["first_char"] : whole["end_char"]] == PASSAGE


def test_what_is_no_leak():
    cut = [" ".join(WORDS[3:15]), " ".join(WORDS[::-1]), " ".join("x" if k % 4 == 2 else w for k, w in enumerate(WORDS)), "", None, "Τάχα η πομπή του αγιογράφου"]
    assert found(*cut)[0] == set()


def test_short_passages_many_items_and_small_shards(monkeypatch):
    monkeypatch.setattr(leaks, "SHARD_WORDS", 30)
    got, _ = found("ένα δύο τρία", PASSAGE, "δύο τρία τέσσερα", PASSAGE, items=((1, PASSAGE), (2, "δύο τρία"), (3, ""), (4, None), (5, PASSAGE)))
    assert got == {(0, 2), (2, 2), (1, 1), (3, 1), (1, 5), (3, 5)}


def test_markup_stays_markup_when_the_cache_is_emptied(monkeypatch):
    text = "πριν " + " ".join(f"<p>{w}</p>" for w in WORDS) + " μετά"
    want = found(text)[1].values.tolist()
    monkeypatch.setattr(leaks, "KNOWN_WORDS", 4)
    assert found(text)[1].values.tolist() == want and len(want) == 1


def test_long_text():
    got, _ = found("λέξη " * 50_000 + PASSAGE + " λέξη" * 50_000)
    assert got == {(0, 1)}


def test_fold():
    assert fold("ΤΕΎΧΟΣ") == fold("τεύχος") == "τευχοσ"


@pytest.mark.parametrize("edit", ["other", "missing", "extra"])
@pytest.mark.parametrize("n", [8, 9, 12, 15, 16, 17, 18, 24])
def test_one_error_at_every_place_is_found(n, edit):
    item = ((1, " ".join(WORDS[:n])),)
    texts = []
    for k in range(n):
        w = WORDS[:n]
        w[k : k + 1] = {"other": ["ξένη"], "missing": [], "extra": [w[k], "ξένη"]}[edit]
        texts.append("πριν από αυτό " + " ".join(w) + " και μετά αυτό")
    assert {d for d, _ in found(*texts, items=item)[0]} == set(range(n))


@pytest.mark.parametrize("n", [16, 17, 20])
def test_two_errors_at_every_pair_of_places_are_found(n):
    pairs = [(a, b) for a in range(n) for b in range(a + 1, n)]
    texts = [" ".join(["αρχή"] + ["ξένη" if k in p else w for k, w in enumerate(WORDS[:n])] + ["τέλος"]) for p in pairs]
    assert len(found(*texts, items=((1, " ".join(WORDS[:n])),))[0]) == len(pairs)
    three = [" ".join("ξένη" if k in (a, a + 5, a + 10) else w for k, w in enumerate(WORDS[:17])) for a in range(2, 5)]
    assert found(*three, items=((1, " ".join(WORDS[:17])),))[0] == set()


def test_seven_words_must_stand_whole():
    item = ((1, " ".join(WORDS[:7])),)
    assert found(" ".join(WORDS[:7]), " ".join(WORDS[:6]), " ".join([*WORDS[:3], "x", *WORDS[4:7]]), items=item)[0] == {(0, 1)}


def test_words_split_and_written_together_cost_nothing():
    w = WORDS[:20]
    split = [w[0], *[x for k in w[1:6] for x in ([k[:3], k[3:]] if len(k) > 6 else [k])], *w[6:14], w[14] + w[15], *w[16:20]]
    text = "αρχή " + " ".join(split) + " τέλος"
    got, out = found(text, items=((1, " ".join(w)),))
    assert got == {(0, 1)}
    r = out.iloc[0]
    assert text[r["first_char"] : r["end_char"]] == " ".join(split)


def test_find_leaks(spark, monkeypatch):
    docs = spark.createDataFrame([(1, PASSAGE, 5), (2, None, 5), (3, "τίποτε", 5), (1, PASSAGE, 5)], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(7, PASSAGE), (8, None), (9, "άλλα λόγια " * 20), (10, " ".join(WORDS[5:30]))], "item_id bigint, passage string")
    whole = sorted(map(tuple, leaks.find_leaks(docs, items).collect()))
    assert [r[:2] for r in whole] == [(1, 7), (1, 7), (1, 10), (1, 10)]
    monkeypatch.setattr(leaks, "BLOCK_CHARS", 1)
    assert sorted(map(tuple, leaks.find_leaks(docs, items).collect())) == whole
    assert leaks.find_leaks(docs.limit(0), items).count() == 0 == leaks.find_leaks(docs, items.limit(0)).count()
    monkeypatch.setattr(leaks, "MAX_VOCABULARY", 3)
    with pytest.raises(ValueError, match="distinct words"):
        leaks.find_leaks(docs, items)
