"""Personal information inside free text (problem 8).

Method. Regular expressions propose spans, each with its kind's shape; the
shape's checksum validator (Luhn, mod-97, mod-11, Verhoeff, check letters,
number ranges) then confirms or refutes a number, and words near the span
adjust the score. A span counts from ``THRESHOLD`` on; overlapping spans go to
the higher score, then the longer, then the earlier one.

Numbers. Without a label a number is an identity number only if its validator
confirms it; a label before it (`passport`, `PESEL`) carries a number whose
check digits are wrong; a weaker hint behind it (`issued to`) carries numbers
of shapes without a validator and confirmed ones, not refuted ones. A number
that mod-97 or Luhn confirms as a bank account or payment card is neither an
identity nor a phone number.

One pass over each whole text, in Arrow batches, without a shuffle.

Cases: null or empty texts give no span and stay as they are; a value that a
text holds several times is reported once and masked everywhere; very long
texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

THRESHOLD = 0.6
KINDS = ("email", "phone", "national_id", "street_address", "person_name")


class Span(NamedTuple):
    start: int
    end: int
    kind: str
    score: float


# -- checksums ---------------------------------------------------------------


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def mod97(text: str) -> bool:
    """ISO 7064 mod 97-10 over letters and digits."""
    return int("".join(str(int(c, 36)) for c in text)) % 97 == 1


def mod11_pair(digits: str) -> bool:
    """Two check digits, each a weighted sum modulo 11, at the end of eleven digits."""
    n = [int(c) for c in digits]
    for k in (9, 10):
        r = sum(x * (k + 1 - i) for i, x in enumerate(n[:k])) * 10 % 11 % 10
        if r != n[k]:
            return False
    return True


def weighted10(digits: str) -> bool:
    """Eleven digits with weights 1 3 7 9, the last being the check digit."""
    return sum(int(c) * w for c, w in zip(digits, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1))) % 10 == 0


def verhoeff(digits: str) -> bool:
    """Dihedral-group check digit."""

    def times(a: int, b: int) -> int:
        if a < 5:
            return (a + b) % 5 + (5 if b >= 5 else 0)
        return ((a - b) % 5) + (5 if b < 5 else 0)

    def power(i: int, d: int) -> int:
        step = (1, 5, 7, 6, 2, 8, 3, 0, 9, 4)
        for _ in range(i % 8):
            d = step[d]
        return d

    c = 0
    for i, x in enumerate(reversed(digits)):
        c = times(c, power(i, int(x)))
    return c == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if c.isdigit())


def _day(yymmdd: str) -> bool:
    return 1 <= int(yymmdd[2:4]) % 20 <= 12 and 1 <= int(yymmdd[4:6]) <= 31


def eleven_digits(text: str) -> bool:
    """Birth date and weighted check digit, or two check digits modulo 11, or nine digits and their complement modulo 97."""
    d = digits_of(text)
    return (weighted10(d) and _day(d)) or mod11_pair(d) or (int(d[9:]) == 97 - int(d[:9]) % 97 and _day(d))


def twelve_digits(text: str) -> bool:
    d = digits_of(text)
    return d[0] not in "01" and verhoeff(d)


def nine_digits(text: str) -> bool:
    """Luhn, or a last digit from the weighted sum modulo 11."""
    d = digits_of(text)
    return d[0] != "0" and (luhn(d) or (11 - sum(int(c) * w for c, w in zip(d, range(9, 1, -1))) % 11) % 11 % 10 == int(d[8]))


def area_group_serial(text: str) -> bool:
    """Ranges in which numbers of three, two and four digits are issued."""
    d = digits_of(text)
    return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"


def prefix_letters(text: str) -> bool:
    """Letter pairs with which such numbers begin."""
    return text[0] not in "DFIQUV" and text[1] not in "DFIOQUV" and text[:2] not in ("BG", "GB", "KN", "NK", "NT", "TN", "ZZ")


def check_letter(text: str) -> bool:
    """Eight digits whose remainder by 23 names the letter."""
    return text[-1].upper() == "TRWAGMYFPDXBNJZSQVHLCKE"[int(digits_of(text)) % 23]


def luhn_date(text: str) -> bool:
    """Luhn over a number that begins with a birth date."""
    d = digits_of(text)
    return luhn(d) and _day(d)


def key_of_97(text: str) -> bool:
    """Thirteen digits and their complement modulo 97."""
    d = digits_of(text)
    return int(d[13:]) == 97 - int(d[:13]) % 97


def account(text: str) -> bool:
    """Bank account by mod-97."""
    t = regex.sub(r"[ -]", "", text).upper()
    return mod97(t[4:] + t[:4])


def card(text: str) -> bool:
    d = digits_of(text)
    return d[0] in "3456" and luhn(d)


# -- proposals ---------------------------------------------------------------

_WORD_SIGN = regex.compile(r"[\p{L}\p{M}\p{N}_]")
_W = r"[\p{L}\p{M}'’-]"
EMAIL = regex.compile(r"(?<![\w.%+-])[\w.%+-]+(?:@| @ ?|@ )[\p{L}\d-]+(?:\.[\p{L}\d-]+)*\.\p{L}{2,}(?![\p{L}\d])")
EMAIL_SPELT = regex.compile(
    r"(?<![\w.%+-])[\w%+-]+(?:(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?|\s+dot\s+)[\w%+-]+)*"
    r"(?:\s?[\[({<]\s?(?:at|@)\s?[\])}>]\s?|\s+at\s+)"
    r"[\p{L}\d-]+(?:(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\s+dot\s+|\.)[\p{L}\d-]+)*(?:\s?[\[({<]\s?(?:dot|\.)\s?[\])}>]\s?|\s+dot\s+)\p{L}{2,}(?![\p{L}\d])",
    regex.I,
)
# an "at" and a "dot" not far behind it: a cheap look before the pattern above
_SPELT = regex.compile(r"(?:\sat\s+|[\[({<]\s?(?:at|@)\s?[\])}>]\s?)[\p{L}\d-][^\n]{0,200}?(?:\sdot\s|[\[({<]\s?(?:dot|\.)\s?[\])}>])")
PHONE = regex.compile(
    r"(?<![\w.+/-])(?<!\d )(?:"
    r"(?:\+|00)\d{1,3}[ .-]?(?:\(\d{1,5}\)[ .-]?)?\d{1,5}(?:[ .-]?\d{2,4}){1,4}"
    r"|\+\d{8,15}"
    r"|(?:\+\d{1,3} ?)?\(\d{2,5}\)[ .-]?\d{3,4}(?:[ .-]?\d{3,4})?"
    r"|0\d{2,4}[ -]?\d{3}[ -]?\d{3,4}"
    r"|\d{3}([ .-])\d{3}\1\d{4}"
    r")(?![\w/]|[.-]\d)"
)
# name of the shape, its pattern, its own weight, its validator
ID_SHAPES = tuple(
    (name, regex.compile(rf"(?<![\w./+-]){shape}(?![\w/-])"), weight)
    for name, shape, weight in (
        ("two letters, six digits, letter", r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]", 0.5),
        ("3.3.3-2", r"\d{3}\.\d{3}\.\d{3}-\d{2}", 0.4),
        ("3-2-4", r"\d{3}-\d{2}-\d{4}", 0.4),
        ("3 2 4", r"\d{3} \d{2} \d{4}", 0.2),
        ("two letters and digits", r"[A-Z]{2}\d{6,7}", 0.2),
        ("12 digits", r"\d{4}[ -]?\d{4}[ -]?\d{4}", 0.2),
        ("11 digits", r"(?:\d{11}|\d{2}\.\d{2}\.\d{2}-\d{3}\.\d{2})", 0.2),
        ("9 digits", r"\d{3}[ -]?\d{3}[ -]?\d{3}", 0.15),
        ("8 digits and letter", r"\d{8}-?[A-Z]", 0.3),
        ("13 digits", r"\d{13}", 0.2),
        ("6-4", r"\d{6}[-+]\d{4}", 0.2),
        ("1 2 2 2 3 3 2", r"[12] ?\d{2} ?\d{2} ?\d{2} ?\d{3} ?\d{3} ?\d{2}", 0.2),
    )
)
# eight digits or more, or two letters and six digits: without them no shape fits
_ID_LIKE = regex.compile(r"\d(?:[ .+-]?\d){7}|[A-Z]{2} ?\d\d ?\d\d ?\d\d")
VALIDATORS = {
    "two letters, six digits, letter": prefix_letters, "3.3.3-2": lambda t: mod11_pair(digits_of(t)), "3-2-4": area_group_serial, "3 2 4": area_group_serial, "12 digits": twelve_digits, "11 digits": eleven_digits,
    "9 digits": nine_digits, "8 digits and letter": check_letter, "13 digits": luhn_date, "6-4": luhn_date, "1 2 2 2 3 3 2": key_of_97,
}
# Shapes whose confirmation a number passes by chance too often to count without any hint.
FAINT = {"9 digits", "3 2 4"}
CONFIRMED, REFUTED, LABEL, HINT, OTHER = 0.45, -0.25, 0.75, 0.5, -0.75
ACCOUNTS = ((regex.compile(r"(?<!\w)[A-Z]{2}\d{2}(?: ?[A-Z\d]{4}){2,7}(?: ?[A-Z\d]{1,3})?(?!\w)"), account), (regex.compile(r"(?<![\w.+-])\d{4}(?:[ -]?\d{4}){2}[ -]?\d{1,4}(?:[ -]?\d{1,3})?(?![\w-])"), card))
_NUMBER = r"\d{1,4}(?:[ ]?[A-Za-z])?(?:/\d{1,4}[A-Za-z]?)?"
_TITLE = rf"(?:\p{{Lu}}{_W}*|d[aeo]s?|l[ao]s?|del?|zu[mr]?|am|im|von|an|der|den) ?"
STREETS = (
    regex.compile(  # house number first
        rf"(?<![\w/.,-]){_NUMBER} (?:\p{{Lu}}{_W}* ){{1,3}}(?:Street|Road|Lane|Avenue|Close|Drive|Way|Court|Place|Terrace|Crescent|Square|Boulevard|Walk|Row|Gardens|Grove|Mews|Parade|Quay|Hill|St\.|Rd\.|Ave\."
        r"|STREET|ROAD|LANE|AVENUE|CLOSE|DRIVE|WAY|COURT|PLACE|TERRACE|CRESCENT|SQUARE|BOULEVARD|WALK|ROW|GARDENS|GROVE|MEWS|PARADE|QUAY|HILL)(?![\w-])"
    ),
    regex.compile(rf"(?<![\w-])(?:\p{{Lu}}{_W}* )?\p{{Lu}}{_W}*(?:straße|strasse|str\.|weg|allee|gasse|platz|ring|damm|ufer|chaussee|steig|pfad|zeile|STRASSE|STRAßE|STRAẞE|WEG|ALLEE|GASSE|PLATZ)(?: Nr\.)? {_NUMBER}(?![\w/])"),
    regex.compile(rf"(?<![\w-])(?:[Uu]lica|[Uu]l\.|[Aa]leja|[Aa]l\.|[Pp]lac|[Pp]l\.|[Oo]siedle|[Oo]s\.|ULICA|UL\.|ALEJA|AL\.|PLAC|PL\.) ?(?:\p{{Lu}}{_W}*\.? ){{1,3}}{_NUMBER}(?![\w/])"),
    regex.compile(
        r"(?<![\w-])(?:Calle|Avenida|Pasaje|Plaza|Camino|Paseo|Av\.|Avda\.|C/|Rua|Travessa|Praça|Alameda|Estrada|Largo|CALLE|AVENIDA|PASAJE|PLAZA|CAMINO|PASEO|RUA|TRAVESSA|PRAÇA|ALAMEDA|ESTRADA|LARGO) ?"
        rf"(?:{_TITLE}){{1,5}},? ?(?:(?:[nN]º|[nN]\.º|[nN]°|[nN]úm\.|[nN]o\.) ?)?{_NUMBER}(?![\w/])"
    ),
)
# what stands before the number in the second pattern: a cheap look before it
_AT_NUMBER = regex.compile(r" (?:[Nn][Rr]\. )?\d")
_STREET_ENDS = ("straße", "strasse", "str.", "weg", "allee", "gasse", "platz", "ring", "damm", "ufer", "chaussee", "steig", "pfad", "zeile", "STRASSE", "STRAßE", "STRAẞE", "WEG", "ALLEE", "GASSE", "PLATZ", " Nr.", " NR.")
_LETTERS = regex.compile(r"\p{L}+")
_CAP = r"\p{Lu}\p{Ll}[\p{L}\p{M}'’]*"
_FAMILY = rf"(?:{_CAP}|\p{{Lu}}{{3,}})(?:-(?:{_CAP}|\p{{Lu}}{{3,}}))?"
NAME = regex.compile(
    rf"(?<![\w@.-])(?:\p{{Lu}}{{3,}}(?:-\p{{Lu}}{{3,}})?, (?:{_CAP}|\p{{Lu}}\.|\p{{Lu}}{{3,}})(?: \p{{Lu}}\.)?|(?:{_CAP}|\p{{Lu}}{{3,}}|\p{{Lu}}\.)(?: \p{{Lu}}\.)? {_FAMILY})(?![\w@-])"
)

# -- words nearby ------------------------------------------------------------

# Patterns of what stands before a span are read backwards from it (R). What a number is of, if not of a person; words begin where a word begins.
NUMBER_OTHER = regex.compile(
    r"\b(?:serial|meter|order|drawing|permit|part|article|invoice|batch|unit|tag|model|asset|ticket|lot|plan|sn|reading|line|account|reference|version|case|claim|policy"
    r"|serien|auftrags?|zähler|rechnungs?|zamówieni[ea]|licznika?|faktur[ay]|pedido|medidor|factura|encomenda|fatura|série|serie)(?:nummer|nr)?\b\W{0,3}(?:no|number|nr|nummer|numer|número)?\W{0,3}$",
    regex.I | regex.R,
)
ID_LEFT = regex.compile(
    r"\b(?:(?:national|personal|tax|health|social security|social insurance|insurance|identity|identification|id|citizen|driving licen[cs]e|passport)(?: (?:number|card|document|no|id))+|national id|passport|id|ssn|sin|nino"
    r"|(?:personal|reise)?(?:ausweis|pass)(?:nummer|nr)?|steuer-?id|sozialversicherungsnummer|pesel|dow[oó]d(?:u|em)?(?: osobist[a-z]+)?|paszport[a-z]*|(?:numer )?dokument[a-z]*"
    r"|documento(?: de identi[a-z]+)?|cédula|cpf|dni|nie|nif|rg|pasaporte|passaporte|bilhete(?: de identidade)?|identi(?:dad|dade)"
    r"|(?:form|file|record|register|certificate|application|licen[cs]e) (?:lists|shows|states|gives|names|reads|says|has))\b[^\n.]{0,12}$",
    regex.I | regex.R,
)
ID_RIGHT = regex.compile(r"[,;)]?\s*(?:as the (?:holder|owner|bearer|applicant)|em nome de|a nombre de|posiadacz|ausgestellt für|issued to|belong(?:s|ing) to)", regex.I)
PHONE_LEFT = regex.compile(r"\b(?:tel|telefon|telefone|teléfono|phone|call|ring|number is|mobile|fax|anrufen|dzwonić|llame|ligue|bitte|reach|dial|whatsapp|móvil|handy)\b[^\n]{0,8}$|\($", regex.I | regex.R)
# Words for people by what they do, and what is said before and behind a person's name, by language.
_ROLES = (
    "engineer|operator|technician|inspector|foreman|manager|supervisor|electrician|fitter|welder|driver|clerk|colleague|director|secretary|nurse|teacher|lawyer|resident|neighbou?r|witness|tenant|employee|officer|contractor|visitor|caller|applicant"
    "|ingenieur(?:in)?|techniker(?:in)?|leiter(?:in)?|kolleg(?:e|in)|mitarbeiter(?:in)?|inżynier|kierownik|operatork?a?|pracownik|pracownica"
    "|ingenier[oa]|técnic[oa]|operador[a]?|jef[ea]|vecin[oa]|engenheir[oa]|chefe|colega"
)
_TITLES = "mr|mrs|ms|miss|mx|dr|prof|sir|herrn?|frau|pani?|pana|panem|panią|sr|sra|srta|señora?|senhora?|don|dona|doña"
ROLE = regex.compile(rf"(?:{_ROLES})\b", regex.I)
NAME_LEFT = regex.compile(
    rf"(?:\b(?:{_TITLES}|{_ROLES})\.?"
    r"|\b(?:issued|addressed|sent|assigned|speak|talk|write|reply|repl(?:y|ies)|belongs?|according|refer|forward|go(?:es)?|given|handed) to|\b(?:ask|asked|work|works|worked|look) for|\bon behalf of|\bour colleague"
    r"|\b(?:signed|led|approved|written|prepared|chaired|headed|checked|run) by|\b(?:on (?:duty|call|site|shift)|in charge|responsible|present) (?:was|is|were)|\bmy name is|\bi am"
    r"|\b(?:regards|thanks|thank you|cheers|sincerely|truly|wishes|grüßen|grüße|saludos|atentamente|atenciosamente|obrigad[oa]|pozdrawiam),?"
    r"|\b(?:signed|contact|log|logbook|visitors?|attn|attention|name|author|holder|owner|caller|from|kontakt|contacto|contato|ansprechpartner(?:in)?|unterschrift|verfasser|firmado|firma|autor|podpis|podpisano|assinado|nombre|nome|imię i nazwisko)\s?:"
    r"|\p{L}*(?:leitung|aufsicht|bereitschaft|dienst) (?:hatte|hat|war|übernahm)|\b(?:rückfragen|anfragen|fragen|grüße) an|\bausgestellt (?:für|auf)|\bgezeichnet"
    r"|\bkierował[a]?|\b(?:kierować|dzwonić|pisać) do:?|\bposiadacz(?:ka)?|\bprosić|\bpodpisał[a]?"
    r"|\b(?:dirigió|dirigido por|firmado por)|\b(?:consultas|preguntas) a|\bpreguntar por|\ba (?:nombre|cargo) de"
    r"|\b(?:chefiado|assinado|dirigido) por|\b(?:falar|dúvidas|contato) com|\bem nome de)\s*$",
    regex.I | regex.R,
)
NAME_RIGHT = regex.compile(
    r"(?:,? (?:(?:national|personal) id|(?:identity|id|passport) (?:number|no)|passport|pesel|cpf|dni|shift lead|plant manager|resident of|geboren|born|aged \d|ur\.|nacid[oa]|nascid[oa])\b"
    r"| (?:lives|lived|resides|wohnt|mieszka|vive|mora)\b"
    r"| (?:called|phoned|rang|said|says|told|asked|wrote|emailed|replied|complained|apologi[sz]ed|sagte|rief|schrieb|bat|fragte|powiedział[a]?|zadzwonił[a]?|napisał[a]?|poprosił[a]?|dijo|llamó|escribió|pidió|disse|ligou|escreveu|pediu)\b"
    r"| \((?:\+\d|0\d{3}|\(\d{3}\)|\d{3}[.-]\d{3}[.-]\d{4}))",
    regex.I,
)
_TO_MAIL = regex.compile(r",? (?:at )?")
NAME_OTHER_LEFT = regex.compile(r"\b(?:the|at|of|for|unit|near|in|na|im|w|en|no|em)\s$|\bnamed after \w* ?$", regex.I | regex.R)
NAME_OTHER_RIGHT = regex.compile(
    r"(?:\s?(?:&|and Sons)|,? (?:hydro|power|solar|wind|nuclear|scheme|station|plant|farm|dam|reservoir|ltd|inc|gmbh|plc|llc|partners|avenue|road|lane|street|drive|close|foundation)\b)", regex.I
)
# Words of grammar and of forms that a sentence begins with: never part of a name.
_NOT_NAMES = frozenset(
    """the this that these those there a an and or but for from with without at in on of to by as if it he she we you they i my our your his her their is was are were has had no not
    one two all each every any some when while after before since unit order serial meter drawing permit line summary update note report contact tel telefon telefone teléfono phone fax mobile badge signed questions send reply call re cc mr mrs ms miss dr prof sir herr frau pan pani sr sra
    according der die das den dem des ein eine und oder mit von im zu für laut nach bei las los el la un y o con por para del al de em na no os as um e do da com w i z do od po przez według""".split()
)


def _accounts(text: str) -> list[tuple[int, int]]:
    """Where the text has numbers that a checksum confirms as accounts or cards."""
    return [m.span() for shape, valid in ACCOUNTS for m in shape.finditer(text) if valid(m.group())]


def number_score(shape: str, weight: float, text: str, start: int, end: int) -> float:
    """Score of a number in a text as an identity number."""
    left = (text, max(0, start - 40), start)
    labelled, hinted = bool(ID_LEFT.match(*left)), bool(ID_RIGHT.match(text, end))
    score = weight + LABEL * labelled + HINT * hinted + OTHER * bool(NUMBER_OTHER.match(*left))
    valid = VALIDATORS.get(shape)
    if valid is not None:
        if not valid(text[start:end]):
            score += REFUTED
        elif labelled or hinted or shape not in FAINT:
            score += CONFIRMED
    return score


def find_spans(text: str) -> list[Span]:
    """All accepted spans of a text, in order, without overlaps."""
    if not text:
        return []
    out: list[Span] = []
    if "@" in text:
        out += [Span(m.start(), m.end(), "email", 1.0) for m in EMAIL.finditer(text)]
    low = text.lower()
    if " at " in low or "at]" in low or "at)" in low or "at}" in low or "at>" in low or "@ " in low or "[@" in low or "(@" in low:
        if _SPELT.search(low):
            out += [Span(m.start(), m.end(), "email", 0.95) for m in EMAIL_SPELT.finditer(text)]
    phones = list(PHONE.finditer(text))
    numbers = [(name, weight, m) for name, shape, weight in ID_SHAPES for m in shape.finditer(text)] if _ID_LIKE.search(text) else []
    held = _accounts(text) if phones or numbers else []
    free = lambda a, b: all(b <= x or a >= y for x, y in held)
    for m in phones:
        start, end = m.span()
        n = sum(c.isdigit() for c in m.group())
        if not 7 <= n <= 15 or not free(start, end):
            continue
        left = (text, max(0, start - 30), start)
        score = 0.7 + 0.2 * bool(PHONE_LEFT.match(*left)) - 0.6 * bool(NUMBER_OTHER.match(*left)) - 0.4 * bool(ID_LEFT.match(*left))
        out.append(Span(start, end, "phone", score))
    for name, weight, m in numbers:
        if free(*m.span()):
            out.append(Span(m.start(), m.end(), "national_id", number_score(name, weight, text, *m.span())))
    for street in STREETS:
        if street is STREETS[1] and not any(text.endswith(_STREET_ENDS, 0, m.start()) for m in _AT_NUMBER.finditer(text)):
            continue
        out += [Span(m.start(), m.end(), "street_address", 0.9) for m in street.finditer(text)]
    blocks = {s.start for s in out if s.kind == "street_address"}
    at = 0
    while m := NAME.search(text, at):
        start, end = m.span()
        left = (text, max(0, start - 60), start)
        at = start + 1
        while at < end and not (text[at - 1].isspace()):
            at += 1
        words = _LETTERS.findall(m.group())
        if any(len(w) > 1 and w.lower() in _NOT_NAMES for w in words):
            continue
        said = NAME_LEFT.match(*left)
        # in a line of capitals a word in capitals behind a role is just the next word
        near = said is not None and not (m.group().isupper() and said.group().isupper() and "," not in m.group() and ROLE.match(said.group()))
        mail = _TO_MAIL.match(text, end)
        after = bool(NAME_RIGHT.match(text, end)) or bool(mail and (EMAIL.match(text, mail.end()) or EMAIL_SPELT.match(text, mail.end())))
        after |= text[end : end + 1] == "\n" and end + 1 in blocks
        score = 0.1 + 0.7 * near + 0.6 * after - 0.6 * bool(NAME_OTHER_RIGHT.match(text, end))
        score -= 0.4 * (not near and bool(NAME_OTHER_LEFT.match(*left)))
        if score >= THRESHOLD:
            out.append(Span(start, end, "person_name", score))
            at = end
    chosen: list[Span] = []
    taken: list[tuple[int, int]] = []
    for s in sorted((s for s in out if s.score >= THRESHOLD), key=lambda s: (-s.score, s.start - s.end, s.start)):
        if all(s.end <= a or s.start >= b for a, b in taken):
            chosen.append(s)
            taken.append((s.start, s.end))
    return sorted(chosen)


def everywhere(text: str, spans: list[Span]) -> list[Span]:
    """``spans`` and every further place where the text has one of their values as whole words; longer values first."""
    taken = bytearray(len(text))
    for s in spans:
        taken[s.start : s.end] = b"\1" * (s.end - s.start)
    out = list(spans)
    for value, s in sorted({text[s.start : s.end]: s for s in spans}.items(), key=lambda x: (-len(x[0]), x[0])):
        at = text.find(value)
        while at >= 0:
            end = at + len(value)
            if any(taken[at:end]) or (_WORD_SIGN.match(text, at - 1) if at else None) or _WORD_SIGN.match(text, end):
                at = text.find(value, at + 1)
                continue
            taken[at:end] = b"\1" * len(value)
            out.append(Span(at, end, s.kind, s.score))
            at = text.find(value, end)
    return sorted(out)


def masked(text: str | None) -> str | None:
    """The text with ``[KIND]`` in place of each span, and nothing else changed."""
    if not text:
        return text
    out, at = [], 0
    for s in everywhere(text, find_spans(text)):
        out += [text[at : s.start], f"[{s.kind.upper()}]"]
        at = s.end
    return "".join([*out, text[at:]])


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, pii_kind, pii_text): one row per distinct value in a document."""

    def spans(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for i, t in zip(pdf["id"], pdf["text"]):
                if t:
                    rows += dict.fromkeys((i, s.kind, t[s.start : s.end]) for s in find_spans(t))
            yield pd.DataFrame(rows, columns=["doc_id", "pii_kind", "pii_text"]).astype({"doc_id": "int64"})

    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text is not null")
    return texts.mapInPandas(spans, "doc_id long, pii_kind string, pii_text string")


@F.pandas_udf(T.StringType())
def mask(texts: pd.Series) -> pd.Series:
    return texts.map(masked)


def redact(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``docs`` with typed placeholders in its texts; other columns pass through."""
    return docs.withColumn(text_col, mask(F.col(text_col)))
