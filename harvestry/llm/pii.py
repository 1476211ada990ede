"""Personal information in free text: detection, and typed placeholders with keyed, consistent surrogates."""

from __future__ import annotations

import hashlib
import hmac
import math
import re
import unicodedata
from bisect import bisect_right
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from harvestry.llm.canon import GREEK_TO_LATIN
from harvestry.session import fresh, stored

KINDS = ["email", "phone", "id_number", "street_address", "person_name"]
#: Common given names (Greek ones in Latin letters, nominative).
GIVEN_FEMALE = """alice amelia anastasia angeliki anna anthi artemis aspasia athina camille catherine charlotte chloe christina chrysoula claire danai despoina dimitra dora
eftychia eirini elena eleni eleftheria elisavet elizabeth emily emma evangelia evgenia fotini foteini georgia grace hannah helen helene ioanna irene isabelle jane jeanne joanna judith julia
kalliopi katerina kleio konstantina kyriaki lucy ludivine magda maria marie margaret marina marta mary melina myrto natalia nefeli nora niki olga olivia ourania panagiota paraskevi phoebe polyxeni rachel
rania rebecca rosa rowan ruth sarah sofia sophie sophia stavroula stella susan tatiana thaleia theodora vasiliki victoria virginia viviane xanthi xenia zoe zoi""".split()
GIVEN_MALE = """achilleas aggelos alexandros alexander alexis anastasios andreas andrew anestis anthony antonis apostolos aris aristos aristotelis arthur athanasios bruno charles charalampos christos christophe colin
david daniel dimitris dimitrios dionysis edgar edward efstathios emmanouil evangelos fotis francois frederick george giorgos georgios grigoris harry henri henry iasonas ilias ioannis jacques james jean john joseph kostas konstantinos
kyriakos lazaros leonidas louis loukas lukas manolis marios mark martin matthew michael michalis michel miltiadis nektarios nicolas nikolaos nikos odysseas orestis panagiotis panos patrick paul pavlos peter petros philippe
pierre robert samuel simon sokratis sotiris spyros stamatis stavros stefanos stelios stephen thanasis themis theodoros thomas timothy vangelis vasilis victor william xenofon yannis yiannis""".split()
#: Words before or after a given name that make it a place, a saint or an institution; and words that are no family name.
BEFORE = set("mount saint st sainte cape lake port fort agia agios agioy agias aghia aghios ag ag. isle bay oros limni ormos naos moni".split())
AFTER = set("shoal bay island islands river creek hill hills peak point street road lane avenue square harbour reef ridge valley museum library foundation institute university college school church chapel hall".split())
NO_NAME = set("""the a an in on at of and or for by with from to is was this that these those it he she we they i as if but when where which who what how authors author contact interview supervisor write thanks according
addressee corresponding keywords pages size grant isbn record call accession coordinates readings overall moreover finally however parallel particular contrast afterwards perhaps besides tel tk afm amka
o i to ta oi h ton tin tis toy tou ton me se apo kai gia stin ston sto stis stous syggrafeis epikoinonia synenteyxi paraliptis epivlepon stoicheia ypovlithike sto sti selides megethos epipleon telos synolika paralilla
le la les un une des du de et sous selon contact ecrire direction""".split())
#: Kinds of streets.
EN_STREET = "Street|Road|Lane|Hill|Avenue|Ropewalk|Square|Way|Drive|Court|Close|Terrace|Row|Walk|Place|Gardens|Crescent|Quay|Wharf|Alley|Boulevard|Parade|Mews|St\\.|Rd\\.|Ave\\."
FR_STREET = "rue|avenue|boulevard|place|chemin|quai|impasse|allée|cours|route|ruelle"

_C = "A-ZΑ-ΩΆΈΉΊΌΎΏΪΫÀ-ÖØ-Þ"
_CAP = rf"[{_C}][^\W\d_]*(?:[-'’][^\W\d_]+)*"
_EMAIL = re.compile(
    r"[\w.+%\-]+(?:[@＠]|\s?[\[({<]\s?(?:at|AT|στο|παπάκι|arobase)\s?[\])}>]\s?|\s[@＠]\s)[^\W_][\w\-]*(?:(?:\.|\s?[\[({]\s?(?:dot|DOT|τελεία|point)\s?[\])}]\s?)[^\W_][\w\-]*)*"
    r"(?:\.|\s?[\[({]\s?(?:dot|DOT|τελεία|point)\s?[\])}]\s?)[^\W\d_]{2,}"
)
_MAYBE_EMAIL = re.compile(r"[@＠]|[\[({<]\s?(?:at|AT|στο|παπάκι|arobase)\s?[\])}>]")
_NUMBER = re.compile(r"(?<![\w.,/:-])(?:\+|\()?\d[\d ().\-+]{7,}(?<=\d)(?![\w/])")
_ID = re.compile(
    r"(?i:(?<!\w)(?:α\.?φ\.?μ\.?|αριθμ\w+\s+φορολογικού\s+μητρώου|tax\s+(?:id|number|no\.?)|tin|afm|num[ée]ro\s+fiscal|α\.?μ\.?κ\.?α\.?|αριθμ\w+\s+κοινωνικής\s+ασφάλισης|amka"
    r"|social\s+(?:security|insurance)\s+(?:number|no\.?)|num[ée]ro\s+de\s+s[ée]curit[ée]\s+sociale|α\.?δ\.?τ\.?|(?:αρ\.?\s+)?(?:δελτίου\s+)?ταυτότητα\w*|id\s+card|identity\s+card|carte\s+d['’]identité"
    r"|διαβατήρι\w+|διαβατηρίου|passport|passeport)(?!\w))\s*(?:(?i:number|no|nº|n°|αρ|num[ée]ro)\.?)?\s*[:#]?\s*([A-ZΑ-Ω]{0,3}[ -]?\d(?:[ .-]?\d){5,11})(?!\d)"
)
_GREEK_PREFIX = rf"(?:[Οο]δ[όο]ς|ΟΔΟΣ|[Οο]δού|[Λλ]εωφ\.|ΛΕΩΦ\.|[Λλ]εωφόρο[ςυ]|[Ππ]λατεία[ςε]?|[Ππ]λ\.|[Ππ]άροδος)\s+(?:{_CAP}\s+){{1,4}}(?:αρ\.?\s*|αριθ\.?\s*)?\d{{1,4}}\s?[Α-Ωα-ωA-Z]?(?![\w/])"
_GREEK_PLAIN = rf"(?<![\w.])(?:{_CAP}\s+){{0,2}}[{_C}][^\W\d_]*(?:ου|ού|ων|ών|ης|ής|ας|άς|ΟΥ|ΩΝ|ΗΣ|ΑΣ)\s+(?:αρ\.?\s*|αριθ\.?\s*)?\d{{1,3}}[Α-Ωα-ωA-Z]?(?=\s*(?:[,.;·)|»\n\r]|$))"
_ADDRESS = re.compile(
    rf"{_GREEK_PREFIX}|{_GREEK_PLAIN}"
    rf"|(?<![\w.])(?:No\.?\s*)?\d{{1,4}}\s?[A-Za-z]?,?\s+(?:{_CAP}\s+){{1,4}}(?:{EN_STREET})(?!\w)|(?<!\w)(?:{_CAP}\s+){{1,4}}(?:{EN_STREET}),?\s+(?:No\.?\s*)?\d{{1,4}}[A-Za-z]?(?![\w-])"
    rf"|(?<![\w.])\d{{1,4}}(?:\s?(?:bis|ter))?,?\s+(?:{FR_STREET})\s+(?:(?:de|du|des|la|le|les)\s+|[dl]['’])*{_CAP}(?:\s+{_CAP})*|(?<!\w)(?:{FR_STREET})\s+(?:(?:de|du|des|la|le|les)\s+|[dl]['’])*{_CAP}(?:\s+{_CAP})*,?\s+\d{{1,4}}(?![\w-])"
)
_DIGIT = re.compile(r"\d")
_NUMBERED = (("id_number", _ID, 1), ("phone", _NUMBER, 0), ("street_address", _ADDRESS, 0))
_TOKEN = rf"(?:[{_C}]\.(?![^\W\d_])|{_CAP})"
_RUN = re.compile(rf"(?<![\w.@-]){_TOKEN}(?:,? {_TOKEN})+")
_SPLIT = re.compile(_TOKEN)


def latin(word: str) -> str:
    """Lower Latin letters without accents."""
    w = unicodedata.normalize("NFD", word).lower()
    w = "".join(c for c in w if not unicodedata.combining(c)).replace("ου", "ou")
    return "".join(GREEK_TO_LATIN.get(c, c) for c in w)


def _inflected(names: list[str]) -> set[str]:
    """The names and their Greek genitives and accusatives."""
    out = set()
    for n in names:
        out.add(n)
        if n.endswith("os"):
            out |= {n[:-1], n[:-1] + "u", n[:-2] + "e"}
        elif n.endswith(("as", "is")):
            out.add(n[:-1])
        elif n.endswith(("i", "a", "o")):
            out.add(n + "s")
    return out


FEMALE, MALE = _inflected(GIVEN_FEMALE), _inflected(GIVEN_MALE)
GIVEN = FEMALE | MALE


#: Words that stand before a person in lists, notes and letters (Greek ones in Latin letters), and titles.
ROLES = set("""author authors contact contacts contacting interview interviewer interviewee supervisor advisor adviser editor editors translator translated write written writing by from dear attn attention
depositor addressee recipient signed witness curator librarian archivist director professor prof dr mr mrs ms miss sir madam mme mlle m monsieur madame thanks thank with named called met asked told per colleague student
syggrafeis syggrafeas epikoinonia synenteyxi paraliptis epivlepon epivlepousa meloi melos katathetis katathetria grapste metafrasi metafrastis epimeleia ypografi ypeythynos ypeythyni kyrios kyria kyrioy kyrias kathigitis kathigitria k ka dr. stin ston apo tin ton
contact auteur auteurs ecrire directeur directrice avec selon""".split())
#: Nouns, adjectives and names of times that make a capitalised pair a place, an institution, a title or a date.
NO_PERSON = set("""new north south east west northern southern eastern western central upper lower great old saint royal national public united state city county province republic kingdom empire church cathedral bridge station airport harbor harbour gulf sea ocean lake
january february march april june july august september october november december monday tuesday wednesday thursday friday saturday sunday english greek french german italian european american british
department faculty school centre center ministry council committee association society company press journal review archive archives collection project programme program report chapter section table figure volume edition series annual international world bank access data draft red cross open final black white green blue gold golden house hotel club team union states kingdom
biology history science sciences studies engineering physics chemistry geology archaeology economics policy law laws court day night week year morning evening santa los las san el
enosi politeies evropaiki ethniko ethniki inomenes kratos vouli trapeza ektheli ekthesi meleti dedomena
nea neo neos neas palaia palio palia palaiou ano kato voreia voreio notia notio megali megalo mikri mikro anatoliki dytiki agia agios agioi panepistimio mouseio vivliothiki idryma ypourgeio etaireia syllogos archeio dimos nomos periochi scholi tmima kentro ekdoseis
ianouariou fevrouariou martiou apriliou maiou iouniou iouliou avgoustou septemvriou oktovriou noemvriou dekemvriou deftera triti tetarti pempti paraskevi savvato kyriaki ellada ellados athina thessaloniki
universite musee bibliotheque institut ministere ville saint-pierre""".split())
#: Short words of the three languages that begin sentences or join words (Greek ones in Latin letters).
FUNCTION = NO_NAME | set("""and or but nor so yet not no if then there here now once after before during while until since because although though also only even each every all some any many few most more less such same other another both either neither one two three
who whom whose which what when where why how can could may might must shall should will would do does did has have had be been being are were am you your his her its our their my me him them us into onto over under between among against about above below near along across
they say although perhaps maybe still thus hence indeed instead otherwise meanwhile later earlier first second third last next again always never often see note page pages
ki otan opou opos omos allà alla ite oute mite mono akomi pali osoi oson osa oti pos pou poios ti afou enw eno prin meta kata para pros dia yper ana anti choris dichos isos tacha lene kapoios kapoia kathe ola oloi mia enas ena den min mi na tha as gia tis tou toy ton ten stous stis stoy sta ta tous
antitheta eidikotera ostoso synepos symperasmatika genika opote kathos molonoti episis telika teliko omoios loipon therefore furthermore conversely similarly additionally consequently nevertheless nonetheless likewise accordingly notably specifically generally
toutefois cependant neanmoins enfin ainsi ensuite puis les des est sont dans pour par sur avec sans mais donc car ni que qui dont ou il elle ils elles on nous vous je tu ce cet cette ces son sa ses leur leurs au aux du""".split())
#: Endings of family names, in Latin letters.
FAMILY_END = re.compile(r"(?:akis|aki|oglou|poulos|poulou|idis|idou|idi|iadis|iadou|iadi|adis|adou|atos|atou|eas|elis|eli|itis|iti|otis|oti|akos|akou|ellis|elli|son|sen|man|mann|berg|stein|ez|es|ski|ska|sky|wicz|ov|ova|ev|eva|enko|ian|yan|etti|ini|elli|ard|eau|ier|ez|ley|ton|ford|wood|smith|er)$")
_LOWER_NEXT = re.compile(r"['’]s?\s|\s(?:is|was|has|had|said|says|wrote|writes|asked|told|will|can|lives|works|answers|replied|thanks|and|who|of|a|est|a|et|qui|είναι|ήταν|έχει|είχε|έγραψε|γράφει|απαντά|είπε|λέει|μένει|ζει|και|που|από)\b")
_ROLE_BEFORE = re.compile(r"([^\W\d_]+\.?)[\s:;,(«\"'“–-]*$")
#: Score from which an unlisted pair of capitalised words counts as a person.
PERSON_SCORE = 1.5


def _is_family(token: str) -> bool:
    bare = re.sub(r"['’]s?$", "", token)
    return len(bare) >= 3 and not bare.endswith(".") and latin(bare) not in NO_NAME


def _proper(w: str) -> bool:
    """A capital and small letters, or a doubled name of such parts."""
    return len(w) >= 3 and not w.endswith(".") and all(p[:1].isupper() and p[1:].islower() for p in re.split("[-'’]", w) if p)


def _score(text: str, start: int, end: int, first: str, second: str, comma: bool) -> float:
    """How much an unlisted pair of capitalised words looks like a person: shape, place in the sentence, what stands before and
    behind it, endings, and whether its words also stand there in small letters. Negative infinity: certainly none."""
    low = [latin(first), latin(re.sub(r"['’]s?$", "", second))]
    if any(w in FUNCTION or w in NO_PERSON or w in AFTER or w in BEFORE for w in low):
        return float("-inf")
    line = text.rfind("\n", 0, start) + 1
    before, behind = text[max(line, start - 60) : start], text[end : end + 60].partition("\n")[0]
    m = _ROLE_BEFORE.search(before)
    word = latin(m[1]).rstrip(".") if m else ""
    role = word in ROLES and not (m[1].islower() and word in ("apo", "from", "by", "tin", "ton", "stin", "ston", "with", "avec", "per") and "," not in before[-3:])
    if word in BEFORE or re.search(r"(?i)(?:\b(?:street|road|river|mount|lake|cape|port|of the|rue|avenue)|οδ[όο][ςύ]|λεωφ\S*|πλατεία\S*|όρος|λίμνη)\s*$", before):
        return float("-inf")
    caps = first.isupper() and second.isupper()
    if not caps and not (_proper(first) or first.isupper()) or not caps and not (_proper(re.sub(r"['’]s?$", "", second)) or second.isupper()):
        return float("-inf")
    mixed = first.isupper() != second.isupper() and min(len(first), len(second)) > 2  # a family name in capitals
    score = 0.0 if caps else 1.5 if mixed else 1.0
    score -= 1.0 if re.search(r"(?:ική|ικό|ικός|ικές|ικά|ική|αϊκή|ένη|ένες|ένα)$", first) and not FAMILY_END.search(low[1]) else 0.0  # an adjective and its noun
    opening = not before.strip() or before.rstrip()[-1] in ".!?;·…"
    score += 0.0 if opening else 0.5
    score += 2.0 if role else 0.0
    score += 1.5 if re.match(r"[\s,;:(–-]*\x00", behind) or before.rstrip(" ,;:(–-").endswith("\x00") else 0.0
    score += 1.0 if any(FAMILY_END.search(w) for w in low) else 0.0
    score += 1.0 if _LOWER_NEXT.match(behind) else 0.0
    score += 0.5 if not before.strip(" -*•>\t") and not behind.strip(" .,;") else 0.0  # a line of its own
    item = re.search(r"[:;·(«]\s*$", before) or not before.strip(" -*•>\t")
    closed = not behind.strip(" .,;") or re.match(r"\s*[,;·.):–-]|\s*\x00", behind)
    score += 0.5 if item and closed else 0.0
    score -= 0.5 if comma else 0.0
    score -= 1.0 if re.search(r"(?i)\b(?:in|at|near|στο|στη|στην|στον|σε|à|en|vers)\s+$", before) and not role else 0.0
    for w in (first, second):
        if not w.isupper() and re.search(rf"(?<!\w){re.escape(w.lower())}(?!\w)", text):
            score -= 1.5
    return score


def _names(text: str) -> Iterator[tuple[int, int]]:
    """Spans of full names: a listed given name or an initial with a family name, and unlisted pairs that score as persons."""
    for run in _RUN.finditer(text):
        toks = list(_SPLIT.finditer(run[0]))
        base, used = run.start(), -1
        word = [t[0] for t in toks]
        gap = [""] + [run[0][a.end() : b.start()] for a, b in zip(toks, toks[1:], strict=False)]
        n = len(toks)
        spans: list[tuple[int, int]] = []
        for i in range(n):
            if i <= used:
                continue
            first = last = -1
            if len(word[i]) == 2 and word[i][1] == ".":
                if i + 1 < n and gap[i + 1] == " " and _is_family(word[i + 1]) and latin(word[i + 1]) not in AFTER:
                    first, last = i, i + 1
                elif i and gap[i] == ", " and i - 1 > used and len(word[i - 1]) >= 5 and _is_family(word[i - 1]) and latin(word[i - 1]) not in GIVEN:
                    first, last = i - 1, i
            elif latin(re.sub(r"['’]s?$", "", word[i])) in GIVEN:
                if i and gap[i] == " " and latin(word[i - 1]) in BEFORE:
                    continue
                if i + 2 < n and gap[i + 1] == gap[i + 2] == " " and len(word[i + 1]) == 2 and word[i + 1][1] == "." and _is_family(word[i + 2]):
                    first, last = i, i + 2
                elif i + 1 < n and gap[i + 1] == " " and _is_family(word[i + 1]):
                    if latin(word[i + 1]) in AFTER:
                        continue
                    first, last = i, i + 1
                elif i and i - 1 > used and _is_family(word[i - 1]) and (gap[i] == ", " or word[i - 1].isupper()) and latin(word[i - 1]) not in GIVEN:
                    first, last = i - 1, i
            if first >= 0:
                spans.append((first, last))
                used = last
        taken = {k for a, b in spans for k in range(a, b + 1)}
        wordy = sum(latin(w) not in FUNCTION for w in word) > 5 or all(w.isupper() for w in word) and n > 3
        for i in range(n - 1):
            if i in taken or i + 1 in taken or wordy:
                continue
            a, b, comma = word[i], word[i + 1], gap[i + 1] == ", "
            if a.endswith(".") or (i and gap[i] == " " and (latin(word[i - 1]) in BEFORE or latin(word[i - 1]) in NO_PERSON)):
                continue
            end = i + 1
            if len(b) == 2 and b[1] == "." and i + 2 < n and gap[i + 1] == gap[i + 2] == " " and i + 2 not in taken:
                end, b = i + 2, word[i + 2]
            if a.isupper() and b.isupper() and any(w.isupper() and len(w) > 1 for w in word[:i] + word[end + 1 :]):
                continue
            if b.endswith(".") or (end + 1 < n and gap[end + 1] == " " and latin(word[end + 1]) in AFTER | NO_PERSON):
                continue
            if (comma and not (i == 0 or gap[i] == ", ")) or _score(text, base + toks[i].start(), base + toks[end].end(), a, b, comma) < PERSON_SCORE:
                continue
            spans.append((i, end))
            taken |= set(range(i, end + 1))
        for first, last in spans:
            tail = re.search(r"['’]s?$", word[last])
            yield base + toks[first].start(), base + toks[last].end() - (len(tail[0]) if tail else 0)


def is_phone(number: str) -> bool:
    """A plausible telephone number: Greek (10 digits from 2 or 69), international with + or 00, or area code in brackets."""
    d = re.sub(r"\D", "", number)
    if number.startswith("+") or d.startswith("00"):
        d = d[2:] if d.startswith("00") else d
        return len(d) == 12 and d[2] in "26" if d.startswith("30") else 9 <= len(d) <= 15
    if number.startswith("("):
        return 10 <= len(d) <= 11
    return len(d) == 10 and (d[0] == "2" or d.startswith("69"))


def _phones(m: re.Match) -> Iterator[tuple[int, int]]:
    """The number itself, or the numbers that stand behind one another in it, parted by blanks."""
    if is_phone(m[0]):
        yield m.span()
        return
    parts = list(re.finditer(r"\S+", m[0]))
    i = 0
    while i < len(parts):
        for j in range(len(parts) - 1, i - 1, -1):
            a, b = parts[i].start(), parts[j].end()
            if b - a < len(m[0]) and is_phone(m[0][a:b]):
                yield m.start() + a, m.start() + b
                i = j
                break
        i += 1


def entities(text: str) -> list[tuple[int, int, str]]:
    """All (start, end, kind) of a text in order, without overlaps."""
    found: list[tuple[int, int, str]] = []
    masked = text
    if _MAYBE_EMAIL.search(text):
        for m in _EMAIL.finditer(text):
            found.append((m.start(), m.end(), "email"))
        for a, b, _ in found:
            masked = masked[:a] + "\x00" * (b - a) + masked[b:]
    at = -1
    for digit in _DIGIT.finditer(text):
        if digit.start() < at:
            continue
        start, at = text.rfind("\n", 0, digit.start()) + 1, text.find("\n", digit.start())
        at = len(text) if at < 0 else at
        line, fresh = masked[start:at], []
        for kind, pattern, group in _NUMBERED:
            now = [s for m in pattern.finditer(line) for s in (_phones(m) if kind == "phone" else (m.span(group),))]
            for a, b in now:
                line = line[:a] + "\x00" * (b - a) + line[b:]
            fresh += [(start + a, start + b, kind) for a, b in now]
        if fresh:
            masked = masked[:start] + line + masked[at:]
            found += fresh
    found += [(a, b, "person_name") for a, b in _names(masked)]
    found.sort()
    return found


def normal_form(kind: str, value: str) -> str:
    """What one entity is called however it is written, so that its mentions get one surrogate."""
    if kind == "person_name":
        parts = re.split(r",\s*", value)
        plain = (" ".join(reversed(parts))).split()
        words = [latin(w).rstrip(".") for w in plain]
        if len(words) == 2 and len(parts) == 1 and (words[1] in GIVEN and words[0] not in GIVEN or plain[0].isupper() and len(words[0]) > 1 and not plain[1].isupper() and words[0] not in GIVEN):
            words.reverse()
        return " ".join(re.sub(r"(?<=[a-z]{3})(?:s|u)$", "", w) for w in words)
    if kind in ("phone", "id_number"):
        return re.sub(r"^(0030|30)(?=\d{10}$)", "", re.sub(r"[\W_]", "", value.upper()))
    if kind == "email":
        v = re.sub(r"\s?[\[({<]\s?(?:at|AT|στο|παπάκι|arobase)\s?[\])}>]\s?|\s?[@＠]\s?", "@", value)
        return re.sub(r"\s?[\[({]\s?(?:dot|DOT|τελεία|point)\s?[\])}]\s?", ".", v).lower()
    return latin(re.sub(r"[\W_]+", " ", value)).strip()


def mentions(text: str) -> list[tuple]:
    """``(start, end, line, kind, value, normal, full)`` of everything to replace in a text, in order.

    Names refer to each other inside the text: an initial with a family name is the only full name that it fits, and the
    family name of a full name, standing alone, is that person. Such lone names have the full name in ``full``.
    """
    found = entities(text)
    ends = [m.start() for m in re.finditer("\n", text)]
    out, people, lone = [], {}, {}
    for a, b, kind in found:
        value = text[a:b]
        normal = normal_form(kind, value)
        out.append([a, b, bisect_right(ends, a - 1) + 1 if a else 1, kind, value, normal, None])
        if kind == "person_name":
            words = normal.split()
            if len(words) > 1 and len(words[0]) > 1:
                people.setdefault(words[-1], {})[normal] = value
                family = value.split(",")[0] if "," in value else next((w for w in value.split() if re.sub(r"(?<=[a-z]{3})(?:s|u)$", "", latin(w)) == words[-1]), "")
                if len(family) >= 4:
                    lone.setdefault(family, (normal, value))
    for m in out:
        words = m[5].split()
        if m[3] == "person_name" and len(words) > 1 and len(words[0]) == 1:
            fits = [n for n in people.get(words[-1], ()) if n.startswith(words[0])]
            if len(fits) == 1:
                m[5] = fits[0]
    if lone:
        spans = [(a, b) for a, b, _ in found]
        for family, (normal, value) in lone.items():
            for m in re.finditer(rf"(?<![\w.@-]){re.escape(family)}(?![\w@-])", text):
                k = bisect_right(spans, (m.start(), len(text)))
                if not (k and spans[k - 1][1] > m.start()) and not (k < len(spans) and spans[k][0] < m.end()):
                    out.append([m.start(), m.end(), bisect_right(ends, m.start() - 1) + 1 if m.start() else 1, "person_name", m[0], normal, value])
        out.sort()
        out = [m for i, m in enumerate(out) if not i or out[i - 1][1] <= m[0]]
    return [tuple(m) for m in out]


_SYLLABLES = {"latin": "ba de fi go ku la me ni po ra se ti vo zu bri cle dro fla gre pla ste tra".split(), "greek": "βα δε φι γο κου λα με νι πο ρα σε τι βο ζα βρι κλε δρο φλα γρε πλα στε τρα".split()}
_GREEK_GIVEN = {"f": "Αθηνά Δήμητρα Ειρήνη Ιωάννα Κατερίνα Μαρίνα Νεφέλη Σοφία".split(), "m": "Γιώργος Δημήτρης Ηλίας Κώστας Μάριος Νίκος Παύλος Στέφανος".split()}
_LATIN_GIVEN = {"f": "Anna Clara Emma Irene Julia Marina Sofia Stella".split(), "m": "Adam Felix George Henry Jonas Lucas Oscar Victor".split()}


def surrogate(kind: str, value: str, key: bytes, attempt: int = 0, normal: str | None = None, size: int = 1, full: str | None = None) -> str:
    """A keyed replacement of the same kind, script, gender, case and format; equal entities get equal ones.

    ``normal`` is the entity's normal form where that isn't the value's own, ``size`` how many entities of the kind there
    are: made-up words have so many syllables that a thousand times as many could be told apart, and one more with each
    ``attempt``. Numbers keep their length and network, until after some attempts they give up these too. A ``full`` name
    makes the value a family name alone: the family name of the full name's surrogate.
    """
    normal = normal_form(kind, value) if normal is None else normal
    n = int.from_bytes(hmac.new(key, f"{kind}\x00{normal}\x00{attempt}".encode(), hashlib.blake2b).digest(), "big")
    shown = full or value
    greek = bool(re.search("[Α-Ωα-ωΆ-ώ]", shown))
    letters_needed = lambda base, of: max(base, math.ceil(math.log(1000 * max(1, size), of))) + attempt

    def draw(size: int) -> int:
        nonlocal n
        n, r = divmod(n, size)
        return r

    def word(parts: int) -> str:
        s = _SYLLABLES["greek" if greek else "latin"]
        return "".join(s[draw(len(s))] for _ in range(parts)).capitalize()

    if kind == "person_name":
        words = re.findall(r"[^\W\d_]+", shown)
        given = next((w for w in words if latin(w) in GIVEN), "")
        own = given or next((w for w in words if len(w) > 1), "") if "." not in shown else given
        female = latin(given) in FEMALE or not given and (not shown.rstrip().endswith("ς") if greek else latin(own).endswith(("a", "ie", "ine", "elle")))
        first = (_GREEK_GIVEN if greek else _LATIN_GIVEN)["f" if female else "m"]
        first = first[draw(len(first))]
        family = word(letters_needed(4, 22)) + (("ίδου" if female else "ίδης") if greek else "")
        if full:
            return family.upper() if value.isupper() else family
        if re.match(r"[^\W\d_]\.", value) or re.search(r",\s*[^\W\d_]\.$", value):
            return f"{family}, {first[0]}." if "," in value else f"{first[0]}. {family}"
        if "," in value:
            out = f"{family}, {first}"
        elif value.split()[0].isupper() and not value.isupper() and len(value.split()[0]) > 1:
            out = f"{family.upper()} {first}"
        elif latin(value.split()[0]) in GIVEN or latin(value.split()[-1]) not in GIVEN:
            out = f"{first} {family}"
        else:
            out = f"{family} {first}"
        return out.upper() if value.isupper() else out
    if kind == "email":
        user = "".join("bcdfghjklmnprstvz"[draw(17)] + "aeiou"[draw(5)] for _ in range(letters_needed(5, 85)))
        return f"{user}@mail.example"
    if kind == "street_address":
        number = re.search(r"\d+", value)
        name = word(letters_needed(4, 22))
        fresh = str(1 + draw(180))
        return (f"οδός {name} {fresh}" if greek else f"{name} Street {fresh}" if number and number.start() > 3 else f"{fresh} {name} Street")
    digits = iter("".join(str(draw(10)) for _ in range(60)))
    letters = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧ" if greek else "ABEZHIKMNOPTYX"
    keep = 3 if kind == "phone" and attempt < 4 else 0  # the network of a phone number stays
    out = []
    for c in value:
        if c.isdigit():
            keep, c = (keep - 1, c) if keep else (0, next(digits))
        elif c.isalpha():
            c = letters[draw(len(letters))]
        out.append(c)
    return "".join(out) + "".join(next(digits) for _ in range(attempt // 6))


_FIELDS = ["first", "end", "line_no", "kind", "value", "normal", "full"]
_MENTIONS = ArrayType(StructType([StructField(f, IntegerType() if i < 3 else StringType()) for i, f in enumerate(_FIELDS)]))
_REPORT = ArrayType(StructType([StructField("line_no", LongType()), StructField("kind", StringType()), StructField("surrogate", StringType()), StructField("alone", BooleanType())]))
_REWRITTEN = StructType([StructField("text", StringType()), StructField("n", LongType()), StructField("report", _REPORT)])


def _found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            if text:
                ends = [m.start() for m in re.finditer("\n", text)]
                rows += [(doc, bisect_right(ends, a - 1) + 1 if a else 1, a, b, kind, text[a:b]) for a, b, kind in entities(text)]
        yield pd.DataFrame(rows, columns=["doc_id", "line_no", "first_char", "end_char", "kind", "value"])


def find_entities(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, line_no, first_char, end_char, kind, value`` of everything found; characters from 0, lines from 1.

    Whole texts are read; each row of ``docs`` by itself, without a shuffle. Null and empty texts give nothing.
    """
    picked = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return picked.mapInPandas(_found, "doc_id bigint, line_no bigint, first_char bigint, end_char bigint, kind string, value string")


#: Draws of one entity after which the operator gives up; each makes the space of surrogates larger.
MAX_DRAWS = 64
#: Entities drawn again that are sent to all tasks; more are joined to their mentions, with the same result.
MAX_SENT = 200_000


def _distinct_surrogates(found: DataFrame, ent: str, key: bytes) -> tuple[DataFrame | None, dict[str, int]]:
    """(entities that were drawn again: ``kind, normal, attempt``, or None; how many entities there are of each kind).

    All written forms of all entities stand in one stored table with their surrogates; those whose surrogate stands for
    another entity too, or is a real entity's own, are drawn again, and only they are computed anew. It ends when no such
    surrogate is left, which is the final check; a ValueError is raised after MAX_DRAWS rounds.
    """
    flat = found.select(F.explode(ent).alias("m")).select("m.kind", "m.value", "m.normal", "m.full").groupBy("kind", "value", "normal", "full").agg(F.lit(0).alias("attempt"))
    forms, _ = stored(flat, "entities")
    real, _ = stored(forms.select("kind", "normal").distinct(), "normals")
    sizes = {r["kind"]: r["n"] for r in real.groupBy("kind").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per kind

    @F.pandas_udf(StringType())
    def drawn(kind: pd.Series, value: pd.Series, normal: pd.Series, full: pd.Series, attempt: pd.Series) -> pd.Series:
        rows = zip(kind, value, normal, full, attempt, strict=True)
        return pd.Series([normal_form(k, surrogate(k, v, key, int(t), n, sizes[k], f)) if f is None else None for k, v, n, f, t in rows], dtype=object)

    table = forms.withColumn("s", drawn("kind", "value", "normal", "full", "attempt"))
    again = None
    for _ in range(MAX_DRAWS):
        table, _path = stored(table, "surrogates")
        met = table.where("s IS NOT NULL").groupBy("kind", "s").agg(F.min("normal").alias("keep"), F.max("normal").alias("other"))
        shared = table.join(met.where("keep <> other"), ["kind", "s"]).where(F.col("normal") != F.col("keep")).select("kind", "normal")
        taken = table.join(real.select("kind", F.col("normal").alias("s")), ["kind", "s"], "left_semi").select("kind", "normal")
        clash, _path = stored(shared.unionByName(taken).distinct(), "clashes")
        if clash.isEmpty():
            redrawn = table.where("attempt > 0").select("kind", "normal", "attempt").distinct()
            return (redrawn if again else None), sizes
        again = True
        anew = table.join(clash, ["kind", "normal"], "left_semi").withColumn("attempt", F.col("attempt") + 1)
        table = table.join(clash, ["kind", "normal"], "left_anti").unionByName(anew.withColumn("s", drawn("kind", "value", "normal", "full", "attempt")))
    raise ValueError(f"surrogates still collide after {MAX_DRAWS} draws")


def redact_with_report(docs: DataFrame, key: bytes, text: str = "text") -> tuple[DataFrame, str, str]:
    """(``docs`` with ``text`` replaced, the names of two new columns): how many entities each text had, and the list of its
    placeholders, ``struct<line_no, kind, surrogate, alone>``.

    Detection runs once; its mentions are stored beside the texts. Surrogates are keyed, agree over the whole corpus and
    are distinct (see ``_distinct_surrogates``). Texts don't move unless more than MAX_SENT entities were drawn again.
    """
    rid, ent, redrawn, out, n, report = fresh(docs.columns, "_rid", "_mentions", "_redrawn", "_out", "n_entities", "placeholders")

    @F.pandas_udf(_MENTIONS)
    def detect(texts: pd.Series) -> pd.Series:
        return pd.Series([[dict(zip(_FIELDS, m, strict=True)) for m in mentions(t)] if t else [] for t in texts], dtype=object)

    found, _ = stored(docs.withColumn(rid, F.monotonically_increasing_id()).withColumn(ent, detect(F.col(text))), "mentions")
    again, sizes = _distinct_surrogates(found, ent, key)
    few = again.limit(MAX_SENT + 1).collect() if again is not None else []
    if len(few) <= MAX_SENT:
        sent = docs.sparkSession.sparkContext.broadcast({(r["kind"], r["normal"]): r["attempt"] for r in few})
        found = found.withColumn(redrawn, F.array().cast("array<struct<at:int,attempt:int>>"))
    else:
        sent = docs.sparkSession.sparkContext.broadcast({})
        flat = found.select(F.col(rid).alias("r"), F.posexplode(ent).alias("at", "m")).select("r", "at", "m.kind", "m.normal")
        marks = flat.join(again, ["kind", "normal"]).groupBy("r").agg(F.collect_list(F.struct("at", F.col("attempt").cast("int").alias("attempt"))).alias(redrawn))  # at most a text's mentions
        found = found.join(marks, F.col(rid) == F.col("r"), "left").drop("r")

    @F.pandas_udf(_REWRITTEN)
    def rewrite(texts: pd.Series, lists: pd.Series, again: pd.Series) -> pd.DataFrame:
        new, counts, told, known = [], [], [], sent.value
        for t, ms, marks in zip(texts, lists, again, strict=True):
            parts, at, said = [], 0, []
            draws = {m["at"]: m["attempt"] for m in marks} if marks is not None else {}
            for i, m in enumerate(ms):
                attempt = draws.get(i) or known.get((m["kind"], m["normal"]), 0)
                s = surrogate(m["kind"], m["value"], key, attempt, m["normal"], sizes[m["kind"]], m["full"])
                parts += [t[at : m["first"]], f"[{m['kind'].upper()} {s}]", "\n" * m["value"].count("\n")]
                said.append({"line_no": m["line_no"], "kind": m["kind"], "surrogate": s, "alone": m["full"] is not None})
                at = m["end"]
            new.append(None if t is None else "".join(parts) + t[at:])
            counts.append(len(said))
            told.append(said)
        return pd.DataFrame({"text": new, "n": counts, "report": told})

    own = [c for c in docs.columns if c != text]
    done = found.withColumn(out, rewrite(F.col(text), F.col(ent), F.col(redrawn)))
    return done.select(*own, F.col(f"{out}.text").alias(text), F.col(f"{out}.n").alias(n), F.col(f"{out}.report").alias(report)), n, report


def redact(docs: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """All columns of ``docs`` with ``text`` replaced: every entity by ``[KIND surrogate]``, all else unchanged; and ``n_entities``.

    Surrogates are keyed: mentions of one entity agree over the whole corpus, also a family name standing alone in a text
    that has the full name. Different entities stay different, and no surrogate is a real entity of the corpus. Line ends
    inside an entity stay. Null text stays null; texts that are empty or name nothing stay as they are.
    """
    done, _, report = redact_with_report(docs, key, text)
    return done.drop(report)


def entity_lines(docs: DataFrame, key: bytes, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Each line of a document and each kind that occurs on it: ``doc_id, line_no, kind``, read from the placeholders that
    ``redact`` writes there; family names alone aren't full names and don't count. Documents listed more than once come
    out once."""
    done, _, report = redact_with_report(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), key)
    return done.select("doc_id", F.explode(report).alias("p")).where(~F.col("p.alone")).select("doc_id", "p.line_no", "p.kind").distinct()
