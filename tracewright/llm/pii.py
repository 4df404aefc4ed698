"""Personal information in free text: found, typed, and replaced by placeholders.

Weak supervision. Candidate spans come from shape alone: addresses with an at sign, runs of
digits, a house number beside capitalised words, runs of two to four capitalised words or
initials (in small letters only where a sentence begins or a word announces a person). For
each candidate labelers vote yes, no or nothing: formats, words that in any text announce
such a value or speak against it, the corpus' common words, and for names a gazetteer of
name parts learned from the corpus' own e-mail addresses. Expectation-maximisation over the
counts of the vote patterns of all documents estimates how reliable each labeler is and how
likely each pattern is true; a logistic span classifier over the votes, the shape and the
words around the span is trained on these soft labels and decides every span.

What is learned has a bounded size: the vote patterns (three answers to at most ten
labelers a kind), the common words (words in a share COMMON of all documents: at most words
per document / COMMON), and the classifier. The gazetteer is a counted table: a word is
known if e-mail addresses hold it at least KNOWN times as often as name candidates do, and
it is joined to the candidates' words, so it may grow with the corpus without saturating.
Counts and statistics cover all documents; only the classifier's training rows are a
sample, at most TRAIN_ROWS candidates a kind, the smallest by hash.

Defined results: positions are code points of the text as it is; a null or empty text holds
nothing; of overlapping accepted spans of one document the likelier stays (to one decimal;
then the longer, then the earlier); names inside e-mail addresses do not count; copies of a
document are reported each; extra columns are unread.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracewright.session import broadcast_if_small, stage

TRAIN_ROWS = 20000
COMMON = 0.004
#: A word is a known name part from this many e-mail addresses a name candidate on.
KNOWN = 0.02
HASHED = 512
KINDS = ("email", "phone", "idnum", "address", "name")
PLACEHOLDER = {"email": "[EMAIL]", "phone": "[PHONE]", "idnum": "[ID]", "address": "[ADDRESS]", "name": "[NAME]"}

# --- e-mail ---------------------------------------------------------------------------
_HOST = r"[A-Za-z0-9][A-Za-z0-9\-]*"
_LOCAL_END = re.compile(r"[A-Za-z0-9][A-Za-z0-9._%+\-]*\Z")
_AT_HOST = re.compile(rf"@{_HOST}(?:\.{_HOST})+")
# an at sign with blanks or written out; the local part stands right before it
_SPELLED_AT = re.compile(
    rf"(?:\s?(?:\[at\]|\(at\)|\{{at\}})\s?|\s@\s?|\s?@\s)(?:{_HOST})(?:(?:\.|\s?(?:\[dot\]|\(dot\))\s?){_HOST})+| (?:AT|at) {_HOST}(?: (?:DOT|dot) {_HOST})+", re.I
)
_SPELLED_HINTS = ("[at]", "(at)", "{at}", " @", "@ ", " dot ")
_FILE = re.compile(r"\.(?:jsonl?|csv|py|txt|parquet|yaml|png|jpe?g)$", re.I)
_LONGEST_LOCAL = 64  # longest local part of an address (RFC 5321)

# --- numbers --------------------------------------------------------------------------
NUMBER = re.compile(
    r"(?<![\w.\-/+])(?:\(\d{2,5}\) ?|\+?)\d[\d]*(?:[ .\-/]\d+)*(?:,? (?:ext\.?|x) ?\d{1,5})?(?![\w])|(?<![\w.\-/])[A-Z]{1,2} ?\d[\d \-]{3,13}\d(?: ?[A-Z])?(?![\w\-])"
)
PHONE_FORM = re.compile(
    r"(?:\+\d{1,3}[ .\-/]?(?:\(0\)[ ]?)?\d{1,5}(?:[ .\-/]\d{2,8}){1,5}|\+\d{9,14}|\(\d{2,5}\)[ ]?\d{3,4}[ .\-]\d{3,5}|\d{3}[ .\-]\d{3}[ .\-]\d{4}|00\d{1,3}[ .\-]\d{1,4}[ .\-]\d{3,9}(?:[ .\-]\d{2,6})?|0\d{2,5}[ /\-]\d{3,8}(?:[ \-]\d{2,6})*|0\d(?: \d\d){4})(?:,? (?:ext\.?|x) ?\d{1,5})?"
)
ID_FORM = re.compile(r"\d{3}-\d{2}-\d{4}|\d{3} \d{2} \d{4}|\d{6}-\d{7}|[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-Z]|[A-Z]{1,2}\d{2,4}-\d{3,4}-\d{3,4}|[A-Z]{1,2}\d{6,9}")
DATE_FORM = re.compile(r"(?:19|20)\d\d[.\-/ ](?:0?[1-9]|1[0-2])[.\-/ ](?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])[.\-/ ](?:0?[1-9]|1[0-2])[.\-/ ](?:19|20)\d\d|(?:19|20)\d{6}")
#: Words that say what a figure counts or labels, as long as no sentence ends in between.
NOT_NUMBER = re.compile(
    r"\b(?:serial|part|lot|checksum|hash|commit|version|build|mask|port|counts?|price|row|record|step|frame|isbn|order|invoice|ticket|batch|offset|seed|sample|run|total|seriennummer|artikel|charge|bestellung|rechnung|sku|model)\b[^.\n\d]{0,32}$", re.I
)
PHONE_CUE = re.compile(r"\b(?:call|tel|telephone|telefon|telefonnummer|phone|mobile|mobil|handy|cell|fax|ring|dial|reach|whatsapp|sms|text|hotline|extension|unter|rufnummer|r[üu]ckruf|contact|kontakt|erreichbar)\b[^.\n\d]{0,24}\.?:?\s*$", re.I)
ID_CUE = re.compile(
    r"\b(?:id|identity|identification|identifikation|passport|pass|reisepass|social security|ssn|nino|national insurance|insurance|licen[cs]e|ausweis\w*|personalausweis\w*|steuer\w*|tax|dni|nif|citizen|resident|registration|personal)\b[^.\n\d]{0,24}\.?:?\s*$", re.I
)

# --- addresses ------------------------------------------------------------------------
_CAP = r"[A-ZÄÖÜÉÀ][\w'’ßäöüéèà\-]*"
_TYPE = r"(?:Street|St|Road|Rd|Lane|Ln|Drive|Dr|Avenue|Ave|Boulevard|Blvd|Court|Ct|Way|Close|Terrace|Square|Sq|Place|Pl|Hill|Row|Crescent|Gardens|Grove|Mews|Parkway|Highway|Quay)"
_SUFFIX = r"(?:straße|strasse|str\.|weg|gasse|platz|allee|ufer|ring|damm|steig|chaussee|promenade|stieg|markt)"
_FOREIGN = r"(?:[Rr]ue|[Aa]venue|[Bb]oulevard|[Pp]lace|[Qq]uai|[Vv]ia|[Vv]iale|[Pp]iazza|[Cc]alle|[Pp]laza|[Pp]aseo|[Rr]ua|[Aa]venida)"
_SMALL = r"(?:de|la|le|les|du|des|del|della|di|da|do|dos|of|the|van|von|der|den|y|l'|d')"
_TOWN = rf"(?:,(?: \d{{4,5}})?(?: {_CAP}){{1,2}}(?:,? (?:\d{{4,6}}|[A-Z]{{1,2}}\d[\dA-Z]? \d[A-Z]{{2}}))?(?!\w))?"
# the house number first
ADDRESS_FIRST = re.compile(
    rf"\d{{1,5}}[A-Za-z]?,? (?:{_CAP} ){{1,3}}{_TYPE}(?!\w)\.?{_TOWN}"
    rf"|\d{{1,5}}(?: ?bis)?,? {_FOREIGN}(?: {_SMALL}| {_CAP}){{1,5}}(?<![a-z] de)(?<! la){_TOWN}"
    rf"|\d{{1,4}} [A-Z][a-z]+-(?:ro|daero|gil|dong|gu)(?: \d{{1,4}}(?:beon)?-gil)?(?!\w)(?:, {_CAP})?"
)
# the house number last
ADDRESS_LAST = re.compile(
    rf"(?<!\w)(?:{_FOREIGN}(?: {_SMALL}| {_CAP}){{1,5}},? \d{{1,4}}(?!\w){_TOWN}"
    rf"|(?:Am|An der|An den|Im|In der|Zum|Zur|Auf dem|Auf der|Hinter dem|Unter den) (?:{_CAP} ){{1,2}}\d{{1,4}}[a-z]?(?!\w)(?:, \d{{4,5}} {_CAP})?"
    rf"|(?:(?!(?:An|In|To|At|Nach|Von) ){_CAP} )?[A-ZÄÖÜ][\wßäöü\-]*{_SUFFIX} \d{{1,4}} ?[a-z]?(?!\w)(?:, \d{{4,5}} {_CAP})?"
    rf"|[A-ZÄÖÜ][\wßäöü]*(?:er|en)? (?:Straße|Strasse|Str\.|Weg|Gasse|Platz|Allee|Ring|Damm|Ufer) \d{{1,4}} ?[a-z]?(?!\w)(?:, \d{{4,5}} {_CAP})?"
    rf"|[A-Z][a-z]+-(?:ro|daero|gil|dong) \d{{1,4}}(?!\w)(?:, (?:Unit|Apt\.?|Suite) \d{{1,4}})?"
    rf"|P\.?O\.? Box \d{{1,6}}(?!\w)(?:, {_CAP})?|Postfach \d{{1,6}}(?!\w))"
)
_HOUSE = re.compile(r"(?<![\w.])\d{1,6}[A-Za-z]?(?!\w)")
_REACH = 64  # characters that a street's name may stand before its house number


def _addresses(text: str) -> list[tuple[int, int]]:
    """Spans of the shape of an address. House numbers are looked up first, then the words
    around them, so a text costs what its figures cost."""
    out: list[tuple[int, int]] = []
    for h in _HOUSE.finditer(text):
        a, b = h.span()
        if out and a < out[-1][1]:
            continue
        m = None
        nxt = text[b : b + 3].lstrip(", ")[:1]
        if nxt.isupper() or nxt in _LOWER_STARTS and nxt:
            m = ADDRESS_FIRST.match(text, a)
        if m is None and a > 1 and text[a - 1] == " ":
            word = text[text.rfind(" ", 0, a - 1) + 1 : a - 1].rstrip(",")
            if word[:1].isupper() or word.endswith(_LOWER_STREETS):
                for x in ADDRESS_LAST.finditer(text, max(0, a - _REACH)):
                    if x.end() > a:
                        m = x if x.start() < a else None
                        break
        if m:
            out.append(m.span())
    return out


_LOWER_STARTS = "rabpqvc"  # of rue, avenue, boulevard, place, quai, via, calle
_LOWER_STREETS = ("straße", "strasse", "str.", "weg", "gasse", "platz", "allee", "ufer", "ring", "damm")
ADDRESS_CUE = re.compile(
    r"\b(?:lives?|living|resid(?:es|ing)|moved|move|address|adresse|anschrift|lieferadresse|ship(?:ped|ping)?|deliver(?:ed|y)?|send|sent|post(?:ed)?|mail(?:ed)?|taxi|courier|parcel|package|office|visit|located|headquarters|home|wohnt|wohnhaft|geliefert|lieferung|lieferungen|paket|b[üu]ro)\b[^.\n]{0,28}$", re.I
)

# --- names ----------------------------------------------------------------------------
_UP = r"A-ZÀ-ÖØ-ÞŁŚŻČŠŽ"
_LO = r"a-zß-öø-ÿłśżńćąęóčšžřěığ"
_CAPPED = rf"[{_UP}][{_LO}]+(?:['’\-][{_UP}]?[{_LO}]+)*(?:[{_UP}][{_LO}]+)?"
_ALLCAPS = rf"[{_UP}]{{2,}}(?:['’\-][{_UP}]+)*"
_INITIAL = rf"[{_UP}]\."
_EDGE = r"(?<![\w@.+\-/'’])"
RUN = re.compile(
    rf"{_EDGE}(?:(?:{_INITIAL} ?){{1,2}}{_CAPPED}|(?:{_INITIAL} ?){{1,2}}{_ALLCAPS}|{_CAPPED}(?:,? {_INITIAL}|,? {_CAPPED})+|{_ALLCAPS}(?:,? {_INITIAL}|,? {_ALLCAPS})+)(?![\w@_])"
)
_TOKEN = re.compile(r"[^\s,]+")
_SMALL_NAME = re.compile(rf"(?:[{_LO}]\. ?[{_LO}]{{3,}}|[{_LO}]{{3,}}(?:['’\-][{_LO}]{{2,}})?,? (?:[{_LO}]\. )?[{_LO}]{{3,}}(?:['’\-][{_LO}]{{2,}})?)(?![\w@_.+\-]*@|[\w_]|\.\w)")
#: Words that in any text announce a person (fixed values, general English and German).
PERSON_CUE = re.compile(
    r"(?<!\w)(?:by|ask|tell|thanks to|thank|according to|owner|operator|cc|bcc|contact|name|reviewer|author|from|regards|sincerely|dear|hi|hello|signed|with|attn|(?:dr|mrs|mr|ms|prof)\.?|professor|doctor|herrn?|frau|von|laut|danke an|gr[üu][ßs]e|mit)[:,]? $", re.I
)
SENTENCE_START = re.compile(r"(?:^|[.!?;:]\s+|\n\s*)(?:[-–—>] ?)?$")
SIGNATURE = re.compile(r"(?:^|\n|[.!?\w]\s)\s*[-–—] ?$")
TITLE = set("dr dr. mr mr. mrs mrs. ms ms. prof prof. professor doctor mister captain judge president director herr herrn frau sir madam lady lord".split())
#: What a person does, after the name.
PERSON_AFTER = re.compile(
    r"(?:, (?:who|the|our|a)\b|'s |’s |,? ?[<(]?[\w.+\-]+ ?@| (?:said|says|asked|asks|wants?|wanted|saw|sees|called|calls|wrote|writes|reported|reports|checked|checks|calibrated|confirmed|confirms|noticed|thinks|agreed|agrees|told|will|has|had|can|took|left|joined|replaced|fixed|found|signed|watched|repeated|prefers|and|hat|sagte|sagt|meldet|meldete|meint|bittet|pr[üu]fte|schrieb)\b)", re.I
)
DETERMINER = re.compile(r"(?<!\w)(?:the|a|an|this|that|our|each|every|spare|new|old|der|die|das|den|dem|ein|eine|einen) $", re.I)
PLACE_CUE = re.compile(r"(?<!\w)(?:in|near|at|city of|town of|nach|aus|\d{4,5}) $", re.I)
#: Calendar words are no parts of names.
CALENDAR = set(
    "monday tuesday wednesday thursday friday saturday sunday january february march april may june july august september october november december "
    "montag dienstag mittwoch donnerstag freitag samstag sonntag januar februar märz mai juni juli oktober dezember".split()
)
#: Words of everyday text that are capitalised where a sentence or a title begins.
EVERYDAY = set(
    "the a an this that these those it we you they he she i and or but if when while after before since because as at in on of to from for with without by about over under per then than so not no yes "
    "please yesterday today tomorrow now here there his her its our my your their who what which where how why all some any each every note ask tell call mail send contact see check run review report issue page shift operator owner visitor verdict return reach thanks thank according signed handled hello hi dear regards best kind "
    "new old north south east west upper lower der die das den dem ein eine und oder aber wenn nach vor bei mit von zu am im an in auf für bitte herr frau danke "
    "street road lane drive avenue court square hall room building floor unit suite box university institute company inc ltd gmbh team group department lab laboratory".split()
)
_WORDS = re.compile(r"\w+|[^\w\s]")


def _sign(x: bool | None) -> str:
    return "0" if x is None else "+" if x else "-"


def _hash(text: str) -> int:
    return zlib.crc32(text.lower().encode()) % HASHED


def _shape(s: str) -> str:
    return re.sub(r"[a-zäöüß]+", "a", re.sub(r"[A-ZÄÖÜ]+", "A", re.sub(r"\d", "9", s)))


def _features(s: str, before: str, after: str) -> list[int]:
    """Hashes of the span's shape and of the one and two words on either side."""
    w = _WORDS.findall(before[-48:])[-2:]
    v = _WORDS.findall(after[:48])[:2]
    out = [_hash("shape " + _shape(s))]
    for side, x in (("<", w[::-1]), (">", v)):
        out += [_hash(f"{side}{i}{t}") for i, t in enumerate(x)]
        if len(x) == 2:
            out.append(_hash(side + " ".join(x)))
    return out


def email_parts(address: str) -> list[str]:
    """Name parts of an address's local part: at least two words joined by a sign."""
    local = re.split(r"@|\[at\]|\(at\)|\s", address, maxsplit=1)[0].split("+")[0]
    parts = [re.sub(r"\d+$", "", p).lower() for p in re.split(r"[._\-]", local)]
    return [p for p in parts if len(p) >= 4 and p.isalpha()] if len(parts) > 1 else []


def _emails(text: str) -> list[tuple[int, int, bool]]:
    """(start, end, plain). At signs are looked up first and the local part read backwards,
    over no more than an address may have, so long words cost nothing."""
    out = []

    def local(end: int) -> int | None:
        lo = max(0, end - _LONGEST_LOCAL)
        m = _LOCAL_END.search(text[lo:end])
        if not m:
            return None
        a = lo + m.start()
        return None if a == lo and lo > 0 and re.match(r"[A-Za-z0-9._%+\-]", text[lo - 1]) else a

    at = text.find("@")
    while at >= 0:
        m = _AT_HOST.match(text, at)
        a = local(at) if m else None
        if a is not None:
            out.append((a, m.end(), True))
        at = text.find("@", at + 1)
    low = text.lower()
    if any(h in low for h in _SPELLED_HINTS):
        for m in _SPELLED_AT.finditer(text):
            if not any(a < m.end() and m.start() < b for a, b, _ in out):
                a = local(m.start())
                if a is not None:
                    out.append((a, m.end(), False))
    return out


def _name_spans(text: str, common: set[str]) -> list[tuple[int, int]]:
    """Runs of capitalised words and initials, without the words that no name has; and pairs
    of rare words in small letters where a person is announced or a sentence begins."""
    spans: list[tuple[int, int]] = []
    for m in RUN.finditer(text):
        run: list[tuple[int, int, str]] = []
        tokens = [(m.start() + t.start(), m.start() + t.end(), t.group()) for t in _TOKEN.finditer(m.group())]
        for t in [*tokens, None]:
            low = t[2].lower() if t else ""
            if t and low not in TITLE and (len(t[2]) == 2 and t[2][1] == "." or (low not in common and low not in EVERYDAY and low not in CALENDAR)):
                run.append(t)
                continue
            spans += _windows(run)
            run = []
    return spans


def _windows(run: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    while run and run[-1][2].endswith("."):
        run = run[:-1]
    full = sum(not t[2].endswith(".") for t in run)
    if len(run) < 2 or not full:
        return []
    if full <= 2:
        return [(run[0][0], run[-1][1])]
    out = [(run[0][0], run[-1][1])] if full == 3 else []
    return out + [(run[i][0], run[i + 1][1]) for i in range(len(run) - 1) if not run[i + 1][2].endswith(".")]


def candidates(text: str, common: set[str]) -> list[tuple[str, int, int, str, list[int], list[str]]]:
    """(kind, start, end, votes, features, words) of every candidate span; ``words`` are the
    name parts, of e-mail addresses those that teach the gazetteer."""
    out = []
    emails = _emails(text)
    for a, b, plain in emails:
        s = text[a:b]
        before, after = text[max(0, a - 64) : a], text[b : b + 48]
        cue = re.search(r"(?:\be?-?mail|\bcontact|\bto|\ban|=|<|,|:|\bunter|\bunder|\bat)\s*$", before, re.I)
        ending = re.split(r"\.|\bdot\b|[\[(]dot[\])]", s, flags=re.I)[-1].strip()
        votes = _sign(True) + _sign(ending.isalpha() and len(ending) > 1) + _sign(not _FILE.search(s)) + _sign(True if cue else None)
        out.append(("email", a, b, votes, _features(s, before, after), email_parts(s)))
    taken = [(a, b) for a, b, _ in emails]
    for a, b in _addresses(text):
        if any(x < b and a < y for x, y in taken):
            continue
        before, after = text[max(0, a - 64) : a], text[b : b + 48]
        s = text[a:b]
        alone = (a == 0 or text[a - 1] == "\n") and (b == len(text) or text[b] == "\n")
        votes = (
            _sign(True)
            + _sign(True if ADDRESS_CUE.search(before) else None)
            + _sign(True if re.search(r", (?:\d{4,5} )?\w", s) else None)
            + _sign(True if alone else None)
            + _sign(False if NOT_NUMBER.search(before) or re.match(r"\s?(?:%|N|Nm|mm|ms|Hz|C|degrees?)\b", after) else None)
        )
        taken.append((a, b))
        out.append(("address", a, b, votes, _features(s, before, after), []))
    held = lambda a, b: any(x < b and a < y for x, y in taken)
    for m in NUMBER.finditer(text):
        a, b = m.span()
        s = text[a:b]
        if b - a < 6:
            continue
        digits = sum(ch.isdigit() for ch in s)
        if digits < (6 if s[0].isalpha() else 7) or held(a, b):
            continue
        before, after = text[max(0, a - 64) : a], text[b : b + 48]
        other = NOT_NUMBER.search(before) is not None
        phone, ident, date = PHONE_FORM.fullmatch(s) is not None, ID_FORM.fullmatch(s) is not None, DATE_FORM.fullmatch(s) is not None
        pc, ic = PHONE_CUE.search(before) is not None, ID_CUE.search(before) is not None
        lead = s[0] in "+(0"
        f = _features(s, before, after)
        no = _sign(False if other and not (pc or ic) else None) + _sign(False if date else None)
        if not s[0].isalpha() and digits <= 17:
            size = _sign(9 <= digits <= 15 if not phone else None)
            out.append(("phone", a, b, _sign(phone) + _sign(True if pc else False if ic else None) + no + _sign(False if ident else None) + _sign(True if lead else None) + size, f, []))
        if digits <= 14:
            out.append(("idnum", a, b, _sign(ident) + _sign(True if ic else False if pc else None) + no + _sign(False if lead or (phone and not ident) else None) + _sign(True if s[0].isalpha() else None), f, []))
    found = [(a, b, False) for a, b in _name_spans(text, common)]
    for at in _small_starts(text):
        n = _SMALL_NAME.match(text, at)
        if n:
            parts = re.findall(r"[^\W\d_]{3,}", n.group())
            if parts and not any(p in common or p in EVERYDAY for p in parts):
                found.append((n.start(), n.end(), True))
    for a, b, small in found:
        if held(a, b):
            continue
        s = text[a:b]
        before, after = text[max(0, a - 64) : a], text[b : b + 48]
        parts = [p.lower() for p in re.findall(rf"[{_UP}{_LO}]{{2,}}", s)]
        announced = PERSON_CUE.search(before) is not None or SIGNATURE.search(before) is not None
        acts = PERSON_AFTER.match(after) is not None
        thing = DETERMINER.search(before) is not None or (PLACE_CUE.search(before) is not None and not announced)
        votes = (
            _sign(True if announced else False if thing else None)
            + _sign(True if acts else None)
            + _sign(None if small else True)
            + _sign(True if "." in s or "," in s else None)
            + _sign(False if s.isupper() and not (announced or acts) else None)
        )
        out.append(("name", a, b, votes, _features(s, before, after), parts))
    return out


#: Where two rare words in small letters may be a name: where a sentence begins, after a cue.
_SMALL_START = re.compile(r"[.!?;:\n] ?(?:[-–] )?(?=[a-zß-ÿ])")
_SMALL_CUE = re.compile(
    "(?:"
    + "|".join(w for x in r"by ask thanks_to according_to owner operator cc contact name reviewer author signed dr\. mrs\. mr\. ms\. prof\. herr herrn frau von laut".split() for w in (x.replace("_", " "), x.replace("_", " ").capitalize()))
    + "|-):? (?=[a-zß-ÿ])"
)


def _small_starts(text: str) -> list[int]:
    out = {m.end() for m in _SMALL_START.finditer(text)} | {0}
    for m in _SMALL_CUE.finditer(text):
        a = m.start()
        if a == 0 or not (text[a - 1].isalnum() or text[a - 1] == "_"):
            out.add(m.end())
    return sorted(out)


# --- learning -------------------------------------------------------------------------
#: A common word stands in a run of capitalised words in less than this share of its documents.
IN_RUNS = 0.2


def common_words(documents: DataFrame) -> set[str]:
    """Words in at least a share COMMON of all documents that are no usual part of runs of
    capitalised words (as frequent first names are). Counted over all documents; at most
    words per document / COMMON of them can be."""
    docs = documents.where(F.length("text") > 0).select("text")
    total = docs.count()
    each = lambda found: docs.select(F.explode(F.array_distinct(found)).alias("w")).groupBy("w").count()
    words = F.filter(F.split(F.lower("text"), r"[^\p{L}]+"), lambda w: F.length(w) > 1)
    often = each(words).where(F.col("count") >= max(2.0, COMMON * total)).collect()
    # the later words of runs, and the first one where no sentence begins with it: what is
    # cut off is that word, or the letter before it
    runs = F.regexp_extract_all(F.col("text"), F.lit(r"(?:[\p{Ll},;:] )?\p{Lu}\p{L}+(?:,? \p{Lu}[\p{L}.]+)+"), F.lit(0))
    in_run = F.flatten(F.transform(runs, lambda m: F.slice(F.split(F.lower(F.regexp_replace(m, r"[,.]", "")), " "), 2, 64)))
    names = {r["w"] for r in often}
    pairs = each(in_run).where(F.col("count") >= max(1.0, IN_RUNS * COMMON * total)).collect()
    paired = {r["w"]: r["count"] for r in pairs}
    return {r["w"] for r in often if paired.get(r["w"], 0) < IN_RUNS * r["count"]} & names


SPAN = "struct<kind:int,start:int,stop:int,votes:string,feats:array<int>,words:array<string>>"
_SPAN_PA = pa.struct(
    [("kind", pa.int32()), ("start", pa.int32()), ("stop", pa.int32()), ("votes", pa.string()), ("feats", pa.list_(pa.int32())), ("words", pa.list_(pa.string()))]
)


def all_candidates(documents: DataFrame, common: set[str]) -> DataFrame:
    """(doc_id, text_hash, c): one row per document with candidates."""
    shared = documents.sparkSession.sparkContext.broadcast(common)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            rows = []
            for d, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
                c = candidates(t.as_py(), own)
                if c:
                    rows.append((d, h, [dict(zip(_SPAN_PA.names, (KINDS.index(x[0]), *x[1:]))) for x in c]))
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(_SPAN_PA)))], ["doc_id", "text_hash", "c"])

    docs = documents.where(F.length("text") > 0).select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return docs.mapInArrow(find, f"doc_id long, text_hash long, c array<{SPAN}>")


def gazetteer(spans: DataFrame) -> DataFrame:
    """(word) of the name candidates that e-mail addresses hold often enough."""
    words = spans.select("kind", F.explode("words").alias("word")).groupBy("word").agg(
        F.count(F.when(F.col("kind") == KINDS.index("email"), 1)).alias("n_email"), F.count(F.when(F.col("kind") == KINDS.index("name"), 1)).alias("n_name")
    )
    return words.where((F.col("n_email") > 0) & (F.col("n_name") > 0) & (F.col("n_email") >= KNOWN * F.col("n_name"))).select("word")


def known_votes(c: DataFrame) -> DataFrame:
    """The staged candidates with the gazetteer's two votes behind those of the names: all
    parts known, and any known. Only words of name candidates travel."""
    spans = c.select("uid", F.posexplode("c").alias("pos", "x")).select("uid", "pos", "x.kind", "x.words")
    known = stage(gazetteer(spans), "gazetteer").withColumn("known", F.lit(1))
    words = spans.where(F.col("kind") == KINDS.index("name")).select("uid", "pos", F.explode("words").alias("word"))
    hits = words.join(broadcast_if_small(known, 48), "word", "left").groupBy("uid", "pos").agg(F.count("known").alias("n"), F.count("*").alias("m"))
    by = hits.groupBy("uid").agg(F.map_from_entries(F.collect_list(F.struct("pos", F.when(F.col("n") == F.col("m"), "+0").when(F.col("n") > 0, "0+").otherwise("-0").alias("v")))).alias("gaz"))
    more = lambda x, i: x.withField("votes", F.when(x["kind"] == KINDS.index("name"), F.concat(x["votes"], F.coalesce(F.try_element_at("gaz", i), F.lit("00")))).otherwise(x["votes"]))
    return c.join(by, "uid", "left").select("doc_id", "text_hash", F.transform("c", more).alias("c"))


def reliabilities(patterns: list[tuple[str, int]], rounds: int = 60) -> tuple[dict[str, float], dict]:
    """EM over vote patterns and their counts: the share of true candidates, and for each
    labeler how often it says yes, no or nothing of a true and of a false one. Start: the
    balance of the votes. Returns the posterior of each pattern and the model."""
    v = np.array([[{"+": 0, "-": 1, "0": 2}[c] for c in p] for p, _ in patterns])
    n = np.array([c for _, c in patterns], dtype=float)
    balance = (v == 0).sum(1) - 1.5 * (v == 1).sum(1)
    q = 1 / (1 + np.exp(-1.5 * (balance - 0.5)))
    rates = None
    for _ in range(rounds):
        w = np.stack([n * q, n * (1 - q)])
        prior = np.clip(w.sum(1) / n.sum(), 0.02, 0.98)
        rates = np.stack([[[(w[k] * (v[:, j] == a)).sum() + 0.5 for a in range(3)] for j in range(v.shape[1])] for k in range(2)])
        rates /= rates.sum(2, keepdims=True)
        log = [np.log(prior[k]) + np.log(rates[k][np.arange(v.shape[1]), v]).sum(1) for k in range(2)]
        q = 1 / (1 + np.exp(np.clip(log[1] - log[0], -50, 50)))
        # a clear balance of the votes keeps the meaning of true and false
        firm = 1 / (1 + np.exp(1 - np.abs(balance)))
        q = np.where(balance >= 2, np.maximum(q, firm), np.where(balance <= -2, np.minimum(q, 1 - firm), q))
    return {p: float(x) for (p, _), x in zip(patterns, q)}, {"prior": prior.tolist(), "rates": rates.tolist()}


def design(votes: list[str], feats: list[list[int]]) -> np.ndarray:
    m = len(votes[0]) if votes else 0
    x = np.zeros((len(votes), 1 + 2 * m + HASHED))
    x[:, 0] = 1.0
    for i, (v, f) in enumerate(zip(votes, feats)):
        for j, c in enumerate(v):
            if c != "0":
                x[i, 1 + 2 * j + (c == "-")] = 1.0
        for h in f:
            x[i, 1 + 2 * m + h] = 1.0
    return x


def train(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None) -> np.ndarray:
    """Logistic regression on soft labels by Newton's method, ridge on all but the bias."""
    b = np.zeros(x.shape[1])
    ridge = np.full(x.shape[1], 1.0)
    ridge[0] = 1e-3
    w = np.ones(len(y)) if weight is None else weight
    for _ in range(12):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -30, 30)))
        g = x.T @ (w * (y - p)) - ridge * b
        h = (x * (w * (p * (1 - p) + 1e-6))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(h, g)
        b += step
        if np.abs(step).max() < 1e-4:
            break
    return b


def learn(c: DataFrame) -> dict[int, np.ndarray]:
    """The span classifier of each kind, from the staged candidates of all documents. Equal
    rows of the sample are trained once, with their number as weight."""
    one = c.select("doc_id", F.explode("c").alias("x")).select("doc_id", "x.*")
    counts = one.groupBy("kind", "votes").count().collect()
    models = {}
    h = F.xxhash64("doc_id", "start", "kind")
    for k in sorted({r["kind"] for r in counts}):
        patterns = sorted((r["votes"], r["count"]) for r in counts if r["kind"] == k)
        post, _ = reliabilities(patterns)
        rows = one.where(F.col("kind") == k).orderBy(h, "doc_id", "start").limit(TRAIN_ROWS).groupBy("votes", "feats").count().collect()
        rows.sort(key=lambda r: (r["votes"], r["feats"]))
        x = design([r["votes"] for r in rows], [r["feats"] for r in rows])
        models[k] = train(x, np.array([post[r["votes"]] for r in rows]), np.array([float(r["count"]) for r in rows]))
    return models


def choose(spans: list[dict], models: dict[int, np.ndarray]) -> list[tuple[int, int, int, float]]:
    """Accepted (kind, start, stop, probability) of one document, overlaps resolved."""
    scored = []
    for s in spans:
        b = models.get(s["kind"])
        if b is None:
            continue
        v = s["votes"]
        z = b[0] + sum(b[1 + 2 * j + (ch == "-")] for j, ch in enumerate(v) if ch != "0") + sum(b[1 + 2 * len(v) + h] for h in set(s["feats"]))
        q = 1 / (1 + np.exp(-min(30.0, max(-30.0, z))))
        if q >= 0.5:
            scored.append((-round(float(q), 1), s["start"] - s["stop"], -round(float(q), 6), s["start"], s["kind"], s["stop"]))
    out: list[tuple[int, int, int, float]] = []
    for _, _, q, a, k, b in sorted(scored):
        if all(b <= x or a >= y for _, x, y, _ in out):
            out.append((k, a, b, -q))
    return sorted(out, key=lambda s: s[1])


FOUND = "struct<kind:string,start:long,stop:long,p:double>"


def document_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, text_hash, found): the values of every document that holds any."""
    c = all_candidates(documents, common_words(documents))
    c = stage(c.withColumn("uid", F.monotonically_increasing_id()), "pii")  # fixed once it is written
    c = stage(known_votes(c), "pii-votes")
    models = learn(c)

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        f = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64()), ("p", pa.float64())])
        for b in batches:
            rows = []
            for r in b.to_pylist():
                got = choose(r["c"], models)
                if got:
                    rows.append((r["doc_id"], r["text_hash"], [{"kind": KINDS[k], "start": s, "stop": e, "p": p} for k, s, e, p in got]))
            cols = list(zip(*rows)) if rows else [()] * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(cols, (pa.int64(), pa.int64(), pa.list_(f)))], ["doc_id", "text_hash", "found"])

    return c.mapInArrow(decide, f"doc_id long, text_hash long, found array<{FOUND}>")


def find_spans(documents: DataFrame) -> DataFrame:
    """(doc_id, pii_kind, start_pos, end_pos, probability) of every value."""
    return document_spans(documents).select("doc_id", F.explode("found").alias("f")).select(
        "doc_id", F.col("f.kind").alias("pii_kind"), F.col("f.start").alias("start_pos"), F.col("f.stop").alias("end_pos"), F.col("f.p").alias("probability")
    )


def redact(documents: DataFrame) -> DataFrame:
    """documents with every value in ``text`` replaced by its placeholder. Texts are put
    together in the JVM; of equal texts of one doc_id the spans are the same, so they are
    joined by id and hash, once each."""
    mine = {"__doc", "__hash", "__found"}
    docs = documents.drop(*mine)
    found = stage(document_spans(docs).groupBy("doc_id", "text_hash").agg(F.first("found").alias("__found")), "pii-found")
    side = broadcast_if_small(found.select(F.col("doc_id").alias("__doc"), F.col("text_hash").alias("__hash"), "__found"), 160)
    j = docs.join(side, (F.col("doc_id").cast("long").eqNullSafe(F.col("__doc"))) & (F.xxhash64("text") == F.col("__hash")), "left")
    marks = F.create_map(*(F.lit(x) for kv in PLACEHOLDER.items() for x in kv))
    before = lambda s, i: F.substr("text", F.when(i == 0, 0).otherwise(F.get("__found", i - 1)["stop"]).cast("int") + 1, (s["start"] - F.when(i == 0, 0).otherwise(F.get("__found", i - 1)["stop"])).cast("int"))
    pieces = F.array_join(F.transform("__found", lambda s, i: F.concat(before(s, i), F.element_at(marks, s["kind"]))), "")
    tail = F.substr("text", F.element_at("__found", -1)["stop"].cast("int") + 1, F.length("text"))
    return j.withColumn("text", F.when(F.col("__found").isNull(), F.col("text")).otherwise(F.concat(pieces, tail))).select(*documents.columns)


def found(documents: DataFrame) -> DataFrame:
    return find_spans(documents).select("doc_id", "pii_kind", "start_pos")
