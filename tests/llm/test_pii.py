import re

import pytest

from harvestry.llm import pii
from harvestry.llm.pii import entities, entity_lines, find_entities, is_phone, mentions, normal_form, redact, redact_with_report, surrogate

FOUND = {
    "email": ["a.b+c@mail.host.example", "x86(at)mail.host.example", "k_l [at] post [dot] host [dot] example", "n88 @ petra.invalid", "kst＠lithos.test"],
    "phone": ["+30 210 0000 289", "210.000.3321", "(555) 0179-5279", "+44 20 7946 0309", "24 2 0 0 50 225", "0030 2310 006423", "+30-690-003-7468", "6900073864", "(210) 000-0021"],
    "id_number": ["ΑΦΜ 239 802 567", "α.φ.μ. 683308381", "Α.Μ.Κ.Α.: 020241-68150", "tax id 723949651", "TIN: 612362835", "ID card no. QZ 1614074", "ταυτότητα ΞΚ245331", "ΑΔΤ ΤΖ-819282", "διαβατήριο Φ-516707", "passport no. XK0000000", "αριθμό κοινωνικής ασφάλισης 17014523472"],
    "street_address": ["οδός Τριών Πηγαδιών 29", "Λεωφ. Ανεμώνης 64, Τ.Κ. 957 75", "ΒΟΤΑΝΙΚΟΥ ΚΗΠΟΥ 51", "Κεραμοποιών αρ. 159, 937 93 Ράχη", "60B Three Wells Road", "No. 51, Quarry Lane", "Saltpan Avenue 118", "12, rue des Lilas"],
    "person_name": ["Edgar Brackenlode", "HOLLINDRAKE Edgar", "Kalamoriti, Foteini", "Ψαροκαλάμη, Μυρτώ", "Λ. Ψαροκαλάμης", "Eleni K. Stournareli", "ΜΥΡΤΩ ΦΕΓΓΑΡΟΛΗ"],
}
NOT = ["Martin Shoal and Mount Alice are sites.", "Η Αγία Ελένη και ο Άγιος Πέτρος είναι οικισμοί.", "ISBN 978-0-39707-964-3", "Grant 637-5405-99.", "Call slip 191 7209, reel 26.", "Accession number 811300097, box 23/1944.", "Readings were taken @ 25 °C and @ 12 V.", "Ο σταθμός της οδού Αργαλειού λειτούργησε τα έτη 1953-1994.", "The gauge in Quarry Lane ran from 1955 to 1987.", "Συντεταγμένες 39.16415, 20.38522.", "Σελίδες 56-384, εικόνες 30.", "Record identifier urn:example:c8bef1525b.", "Μέγεθος 5463552 bytes, έκδοση 1.7.6.", "The Dryopi highlands. In parallel, Kalamia."]


@pytest.mark.parametrize(("kind", "text"), [(k, t) for k, ts in FOUND.items() for t in ts])
def test_found(kind, text):
    kinds = [k for *_, k in entities(f"θα δούμε {text}\nκαι τέλος")]
    assert kind in kinds, kinds


@pytest.mark.parametrize("text", NOT)
def test_not_found(text):
    assert entities(text) == []


def test_no_overlap_and_exact_spans():
    text = "Contact: Zoi K. Trichoveloni, zoi.trichoveloni@mail.example, 210 0007288\nοδός Ανεμώνης 92, ΑΦΜ 496488541"
    spans = entities(text)
    assert [text[a:b] for a, b, _ in spans] == ["Zoi K. Trichoveloni", "zoi.trichoveloni@mail.example", "210 0007288", "οδός Ανεμώνης 92", "496488541"]
    assert all(x[1] <= y[0] for x, y in zip(spans, spans[1:], strict=False))


def test_lines_nulls_and_repeats(spark):
    rows = [(1, "τίποτε\nEdgar Brackenlode, 210 0007288\r\nx\n210 0007288 210 0007289", "k"), (2, None, "k"), (3, "", "k"), (1, "τίποτε\nEdgar Brackenlode, 210 0007288\r\nx\n210 0007288 210 0007289", "k"), (4, "a " * 200_000 + "\nEdgar Brackenlode", "k")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, kind string")
    got = sorted((r["doc_id"], r["line_no"], r["kind"]) for r in entity_lines(docs, b"k").collect())
    assert got == [(1, 2, "person_name"), (1, 2, "phone"), (1, 4, "phone"), (4, 2, "person_name")]
    assert find_entities(docs.limit(0)).count() == 0


def test_surrogates():
    key = b"k"
    assert surrogate("person_name", "Edgar Brackenlode", key) == surrogate("person_name", "Edgar Brackenlode", key) != surrogate("person_name", "Edgar Brackenlode", b"other")
    assert normal_form("person_name", "BRACKENLODE Edgar") == normal_form("person_name", "Brackenlode, Edgar") == normal_form("person_name", "Edgar Brackenlode")
    assert normal_form("person_name", "Ζωής Τριχοβελόνη") == normal_form("person_name", "Zoi Trichoveloni")
    assert normal_form("email", "x (at) a [dot] example") == "x@a.example"
    new = surrogate("phone", "+30 210 0000 289", key)
    assert len(new) == len("+30 210 0000 289") and new.startswith("+30 2") and is_phone(new)
    assert surrogate("person_name", "Ζωή Τριχοβελόνη", key).split()[1].endswith("ίδου") and surrogate("person_name", "Πέτρος Αλατοζύγης", key).endswith("ίδης")
    assert surrogate("person_name", "Brackenlode, Edgar", key).count(",") == 1


def test_redact_changes_nothing_else(spark):
    text = "Γράψτε: Ζωή Τριχοβελόνη, 210 0007288.\r\nΤέλος — Ζωή Τριχοβελόνη"
    docs = spark.createDataFrame([(1, text, 9, 8), (2, None, 9, 8), (3, "τίποτε", 9, 8)], "doc_id bigint, text string, _r int, n_entities int")
    out = {r["doc_id"]: r for r in redact(docs, b"k").collect()}
    name, phone = surrogate("person_name", "Ζωή Τριχοβελόνη", b"k"), surrogate("phone", "210 0007288", b"k")
    assert out[1]["text"] == f"Γράψτε: [PERSON_NAME {name}], [PHONE {phone}].\r\nΤέλος — [PERSON_NAME {name}]"
    assert out[2]["text"] is None and out[3]["text"] == "τίποτε" and out[1]["n_entities"] == 8 and out[1]["n_entities_"] == 3


def test_redraws_until_all_are_distinct_or_raises(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "Edgar Brackenlode\nEdgar Hollindrake\nEdgar Saltmarsh\nAdam Real")], "doc_id bigint, text string")
    real = pii.surrogate

    def narrow(kind, value, key, attempt=0, normal=None, size=1, full=None):
        return "Adam Same" if attempt < 3 else "Adam Real" if attempt == 3 else real(kind, value, key, attempt, normal, size, full)

    monkeypatch.setattr(pii, "surrogate", narrow)
    names = re.findall(r"\[PERSON_NAME (.*?)\]", redact(docs, b"k").first()["text"])
    assert len(names) == 4 == len(set(names)) and "Adam Real" not in names  # nor is a surrogate a real person
    monkeypatch.setattr(pii, "MAX_SENT", 0)
    assert re.findall(r"\[PERSON_NAME (.*?)\]", redact(docs, b"k").first()["text"]) == names
    monkeypatch.setattr(pii, "MAX_DRAWS", 2)
    with pytest.raises(ValueError, match="still collide"):
        redact(docs, b"k")


def test_surrogates_grow_with_the_number_of_entities():
    short, long = surrogate("person_name", "Edgar Brackenlode", b"k"), surrogate("person_name", "Edgar Brackenlode", b"k", size=10**9)
    assert len(long.split()[1]) > len(short.split()[1])
    made = {surrogate("person_name", f"Edgar Test{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}er", b"k", size=5000) for i in range(5000)}
    assert len(made) > 4990
    assert len(surrogate("phone", "2100007288", b"k", 12)) == 12


def test_names_refer_to_each_other_inside_a_text(spark):
    text = "Edgar Brackenlode wrote it.\nThe letters of Brackenlode and of E. Brackenlode are lost; BRACKENLODES are plants."
    found = mentions(text)
    assert [(m[4], m[5]) for m in found] == [("Edgar Brackenlode", "edgar brackenlode"), ("Brackenlode", "edgar brackenlode"), ("E. Brackenlode", "edgar brackenlode")]
    docs = spark.createDataFrame([(1, text), (2, "Only Brackenlode alone")], "doc_id bigint, text string")
    done, n, report = redact_with_report(docs, b"k")
    out = {r["doc_id"]: r for r in done.collect()}
    new = [p["surrogate"] for p in out[1][report]]
    assert new[0].split()[1] == new[1] == new[2].split()[1] and out[2][n] == 0
    assert sorted(map(tuple, entity_lines(docs, b"k").collect())) == [(1, 1, "person_name"), (1, 2, "person_name")]


#: Names that the code doesn't list, from many languages, and capitalised pairs that name no person.
UNLISTED = """Jennifer Smith|Jessica Brown|Brian Miller|Juliette Marchand|Bogdan Kowalski|Yuki Tanaka|Kwame Mensah|Priya Natarajan|Fatima Haddad|Ευδοκία Μανιάτη|Ashley Johnson|Megan Novak|Olaf Lindqvist|Ingrid Bergström|Giulia Rossi|Carlos Hernández|João Pereira
Wei Zhang|Hiroshi Nakamura|Arjun Patel|Amara Okafor|Zainab Hussein|Leila Benali|Dmitri Volkov|Katarzyna Nowak|Jakub Dvořák|Zsófia Nagy|Ευρυδίκη Σταθοπούλου|Λυκούργος Ράπτης|Πηνελόπη Δελλή|Ραφαήλ Κοντός|Φανή Ζαχαρίου|Στέργιος Μπακάλης|Τηλέμαχος Βούλγαρης
Guillaume Lefèvre|Amélie Rousseau|Élodie Fontaine|Mustafa Yılmaz|Aylin Demir|Nikola Jovanović|Siobhan Kelly|Ruairi Doyle|Tomasz Zieliński|Αρετή Μαυρομάτη|Χαρίλαος Φωτίου|Μελπομένη Ξένου|Anders Holm|Liesbeth Janssen|Pieter Vandenberg|Soledad Ibarra""".replace("\n", "|").split("|")
ENGLISH = ["The letters of {} were found in the attic.", "{} wrote the catalogue in 1932.", "Please contact {} for a copy.", "Author: {}", "Interview with {}, curator.", "{}", "The survey, first proposed by {}, questions the results."]
GREEK = ["Το αρχείο του {} βρέθηκε στη σοφίτα.", "{} έγραψε τον κατάλογο το 1932.", "Επικοινωνία: {}, γραφείο 3.", "Συγγραφέας: {}", "Οι ευχαριστίες οφείλονται στη συμβολή {} κατά τη συλλογή.", "{}"]
NO_NAMES = """The University Library holds the originals.|Mount Olympus is high.|They met in New York last year.|The Black Sea coast was surveyed.|On Monday Morning the gauge failed.|The Ministry of Culture replied.|Quarry Lane was closed.|Στη Νέα Υόρκη έγινε έκθεση.|Το Εθνικό Μουσείο άνοιξε.
At Bartseby, the sounding lead hung.|See Figure Two and Table Three.|Το Πανεπιστήμιο Πατρών ιδρύθηκε.|The Byzantine Empire fell.|The Old Ropewalk burned.|Η Βόρεια Εύβοια υπέφερε.|The Royal Society met.|Digital Library of maps.|Annual Report|North Harbour Bridge|United Kingdom|The Red Cross came.
The Suez Canal opened.|Niagara Falls froze.|Lake Geneva is deep.|The Hague Convention was signed.|Η Μαύρη Θάλασσα είναι βαθιά.|Ο Δήμος Αθηναίων αποφάσισε.|The Iron Age began.|Easter Sunday came early.|The Central Bank paid.|Η Παλαιά Διαθήκη διαβάστηκε.|Magna Carta|Deutsche Bahn ran late.""".replace("\n", "|").split("|")


def test_recall_and_precision_on_unlisted_names():
    assert not {pii.latin(n.split()[0]) for n in UNLISTED} & pii.GIVEN
    cases = [(t.format(n), n) for n in UNLISTED for t in (GREEK if re.search("[α-ω]", n) else ENGLISH)]
    found = sum((t.index(n), t.index(n) + len(n), "person_name") in entities(t) for t, n in cases)
    wrong = [t for t in NO_NAMES if any(k == "person_name" for *_, k in entities(t))]
    assert found / len(cases) >= 0.9 and found / (found + len(wrong)) >= 0.9 and len(wrong) <= 5, (found, len(cases), wrong)
    print(f"recall {found}/{len(cases)}, wrong {wrong}")
