"""Exact shapes of personal information: where a value begins and ends, and how it is written down."""

from __future__ import annotations

import re

KINDS = ("email", "phone", "id_number", "address", "person")

# Same length as the text: full width to ASCII, dashes and spaces to the plain ones.
_FOLD = {c: c - 0xFEE0 for c in range(0xFF01, 0xFF5F)} | {0x3000: 32, 0xA0: 32, 0x202F: 32, 0x2010: 45, 0x2011: 45, 0x2012: 45, 0x2013: 45, 0x2212: 45}


_FOLDED = re.compile(f"[{''.join(map(chr, sorted(_FOLD)))}]")


def fold(text: str) -> str:
    return text.translate(_FOLD) if not text.isascii() and _FOLDED.search(text) else text


_AT = r"(?:@|\s?(?:\(at\)|\[at\]|\{at\})\s?|\s(?:AT|at)\s(?=[\w-]+\s(?:DOT|dot)\s))"
_DOT = r"(?:\.|\s?(?:\(dot\)|\[dot\]|\{dot\})\s?|\s(?:DOT|dot)\s)"
EMAIL = re.compile(rf"(?<![A-Za-z0-9._%+@-])([A-Za-z0-9_](?:[A-Za-z0-9_%+-]|\.(?=[A-Za-z0-9_]))*){_AT}((?:[A-Za-z0-9-]+{_DOT})+[A-Za-z]{{2,24}})(?![A-Za-z0-9_@])", re.I)

# Number plans; every one with word-like surroundings excluded.
_NANP = r"(?:\+?1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}"
_CHINA = r"(?:(?:\+|00)86[ -]?)?(?:1\d{2}[ -]?\d{4}[ -]?\d{4}|(?:\(0\d{2,3}\) ?|0\d{2,3}-)\d{3,4}[ -]?\d{4})"
_BRITAIN = r"(?:(?:\+|00)44 ?(?:\(0\) ?)?|0)(?:\d{2} \d{4} \d{4}|7\d{3} ?\d{6}|\d{3} \d{3} \d{4}|\d{4} \d{6})"
_GERMANY = r"(?:(?:\+|00)49[ /-]?(?:\(0\) ?)?\d{2,4}[ /-]?|\(?0\d{2,4}\)?[ /-])\d{3,8}(?:[ -]\d{1,4})?"
_FRANCE = r"(?:(?:\+|00)33[ .]?(?:\(0\) ?)?|0)\d(?:[ .-]?\d{2}){4}"
_SPAIN = r"(?:(?:\+|00)34[ -]?)?\d{3}[ -]\d{3}[ -]\d{3}"
# Fixed-length numbers that are glued to a date or to the next sentence's count.
_APART = r"(?:0\d{3}-\d{4} \d{4}|1\d{2} \d{4} \d{4}|\+86-\d{3}-\d{4}-\d{4}|\(0\d{3}\)\d{8}|1\d{10})(?=20\d\d-\d\d-\d\d|\d{1,5}(?:位|个|条|件|年|张|名))"
_ABROAD = r"\+\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}"
PHONE = re.compile(
    rf"(?<![A-Za-z0-9_@.+/-])(?:{_APART}|(?:{_NANP}|{_CHINA}|{_BRITAIN}|{_FRANCE}|{_SPAIN}|{_GERMANY}|{_ABROAD})(?![0-9_@])(?![A-WYZa-wyz](?![a-z])|[xX](?![a-z\d]))(?![.,/-]\d))"
)

_RESIDENT = r"\d{6}[ -]?(?:18|19|20)\d{2}(?:0[1-9]|1[0-2])(?:0[1-9]|[12]\d|3[01])[ -]?\d{3}[\dXx]"
_SOCIAL = r"\d{3}[ -]\d{2}[ -]\d{4}"
_INSURANCE = r"[A-Z]{2} ?\d{2} ?\d{2} ?\d{2} ?[A-D]"
_CARD = r"[A-Z]{1,3}\d{6,9}|[XYZ]?\d{7,8}-?[A-Z]"
_FRENCH = r"[12] ?\d{2} ?(?:0[1-9]|1[0-2]) ?\d{2} ?\d{3} ?\d{3} ?\d{2}"
ID_NUMBER = re.compile(rf"(?<![A-Za-z0-9_@./-])(?:{_RESIDENT}|{_SOCIAL}|{_INSURANCE}|{_CARD}|{_FRENCH})(?![A-Za-z0-9_@])(?![./-]\d)")

# Words for order, item, tracking and serial numbers, which are no personal numbers.
_GOODS = re.compile(
    r"(?:order(?:ing)?(?: code)?|item|serial|tracking(?: code)?|parcel|build|firmware|version|isbn|lot|lote|ratio|model"
    r"|订单号|货号|运单号|批次|型号|序列号|sendungsnummer|bestellung|commande|pedido)\W{0,3}(?:no|nr|n[°º])?\W{0,3}$",
    re.I,
)

_CAP = r"[A-ZÀ-ÖØ-Þ][\w'’-]+"
_ENGLISH_STREET = (
    rf"\d{{1,5}}[A-Za-z]?(?:[-/]\d{{1,4}})? (?:{_CAP} ){{1,3}}"
    r"(?:Street|St|Road|Rd|Lane|Ln|Avenue|Ave|Terrace|Ter|Row|Steps|Boulevard|Blvd|Parkway|Pkwy|Drive|Dr|Court|Ct|Way|Close|Place|Pl"
    r"|Square|Sq|Crescent|Hill|Gardens|Walk|Mews|Quay|Wharf|Alley|Green|Grove|Park|Rise|Highway|Hwy|Circle|Trail|Yard|View)(?![\w-])"
)
_FRENCH_STREET = (
    r"\d{1,4}(?: ?(?:bis|ter|quater))?,? (?:rue|avenue|av\.|boulevard|bd|impasse|chemin|allée|place|quai|route|passage|cours|square|villa|sentier|ruelle)"
    rf"(?: (?:de la|de l[’']|des|du|de|d[’']|la|le|les))?(?: ?{_CAP}){{1,3}}"
)
_SPANISH_STREET = (
    rf"(?:Calle|C/|Avenida|Avda\.|Plaza|Paseo|Camino|Carretera|Ronda|Travesía|Callejón)(?: (?:de las|de los|de la|del|de))?(?: {_CAP}){{1,3}},? \d{{1,4}}[A-Za-z]?(?:-\d+)?"
)
_GERMAN_STREET = (
    rf"(?:(?:Am|An der|Im|In der|Auf der|Zum|Zur|Unter den|{_CAP}) )?{_CAP}"
    r"(?:(?<=straße)|(?<=strasse)|(?<=str\.)|(?<=weg)|(?<=gasse)|(?<=platz)|(?<=allee)|(?<=ring)|(?<=damm)|(?<=ufer)|(?<=tal)|(?<=Steig)|(?<=Weg)|(?<=Platz)|(?<=Allee)|(?<=Straße)|(?<=Gasse)|(?<=Ring)|(?<=Ufer))"
    r" \d{1,4} ?[a-h]?(?![\w-])"
)
_HAN = r"[一-鿿]"
_CHINESE_STREET = rf"{_HAN}{{1,6}}?(?:大道|胡同|[路街巷道弄里])\d{{1,5}}(?:[A-Za-z]|-\d+|之\d+)?号"
ADDRESS = re.compile(
    rf"(?<![\w/-])(?:{_ENGLISH_STREET}|{_FRENCH_STREET}|{_SPANISH_STREET}|{_GERMAN_STREET})|{_CHINESE_STREET}"
)
# Words before a Chinese street that don't belong to it.
_BEFORE_STREET = re.compile(r"^.*(?:地址|寄到|寄往|现住|住在|家住|位于|送到|送往|发往|搬到|前往|来自|住址|在|到|于|是)(?=.{2,})")

_WORD = r"[A-ZÀ-ÖØ-Þ](?:[\w'’]+|[A-ZÀ-Þ]+)(?:-[A-ZÀ-Þ][\w'’]+)*"
_LATIN_NAME = re.compile(rf"{_WORD}, {_WORD}(?: [A-Z]\.)*|{_WORD}(?: [A-Z]\.)*(?: (?:van|von|de|der|da|di|del|la|le|bin|al))*(?: {_WORD}){{1,2}}")
_HAN_NAME = re.compile(r"[一-鿿]{2,4}(?:·[一-鿿]{1,6})?")
# Titles and forms of address, which don't belong to a name.
_TITLE = re.compile(
    r"^(?:(?:Mr|Mrs|Ms|Miss|Dr|Prof|Sir|Madam|Herr|Frau|Fräulein|M|Mme|Mlle|Monsieur|Madame|Señora?|Sr|Sra|Srta|Don|Doña|Signora?|Dear)\b\.? ?)+"
)
_HAN_TITLE = re.compile(r"(?:先生|女士|小姐|老师|同学|经理|师傅|医生|教授|主任)$")


def _digits(s: str) -> str:
    return re.sub(r"\D", "", s)


def candidates(text: str, folded: str | None = None) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of everything that has the shape of an e-mail address, phone, id number or address."""
    f = fold(text) if folded is None else folded
    out = []
    if "@" in f or "at" in f or "AT" in f:
        for m in EMAIL.finditer(f):
            local, domain = m[1], re.sub(_DOT, ".", m[2], flags=re.I)
            end = m.end()
            if glued := _GLUED.search(m[2]):  # a sentence that begins right after the address
                end -= len(m[2]) - glued.start(1)
                domain = domain[: len(domain) - (len(m[2]) - glued.start(1))]
            out.append((m.start(), end, "email", f"{local}@{domain}".lower()))
    if _DIGIT.search(f):
        for m in ID_NUMBER.finditer(f):
            if not _GOODS.search(f, max(0, m.start() - 24), m.start()):
                out.append((m.start(), m.end(), "id_number", re.sub(r"[^0-9A-Z]", "", m[0].upper())))
        ids = [(a, b) for a, b, k, _ in out if k == "id_number"]
        for m in PHONE.finditer(f):
            if 8 <= len(_digits(m[0])) <= 15 and not _GOODS.search(f, max(0, m.start() - 24), m.start()):
                if not any(a < m.end() and m.start() < b for a, b in ids):
                    out.append((m.start(), m.end(), "phone", _digits(m[0])))
        for m in ADDRESS.finditer(text):
            a, b = m.span()
            if "一" <= text[a] <= "鿿" and (cut := _BEFORE_STREET.match(text[a:b])):
                a += cut.end()
            out.append((a, b, "address", text[a:b]))
    return out


_GLUED = re.compile(r"[.\]) ][a-z]{2,}([A-Z][a-z]*)$")
_DIGIT = re.compile(r"\d")


def as_decoded(text: str, start: int, end: int, kind: str) -> tuple[int, int, str] | None:
    """A span without a known shape as the model gave it, in the kind's written form; None if it can't be of the kind."""
    span = fold(text[start:end])
    lead = len(span) - len(span.lstrip(" \n\t.,:;#/\"'"))
    span = span[lead:].rstrip(" \n\t.,:;/-\"'")
    start += lead
    end = start + len(span)
    before, after = text[start - 1 : start], text[end : end + 1]
    if before.isascii() and before.isalnum() or after.isascii() and after.isalnum():
        return None  # a part of a longer word or number
    digits = _digits(span)
    if kind == "email":
        value = re.sub(_LOOSE_DOT, ".", re.sub(_LOOSE_AT, "@", span.lower())).replace(" ", "")
        return (start, end, value) if re.fullmatch(r"[^@\s]+@[^@\s.]+(?:\.[^@\s.]+)+", value) else None
    if _GOODS.search(fold(text[max(0, start - 24) : start])):
        return None
    if kind == "phone":  # a plain run of digits would need a known number plan
        return (start, end, digits) if 7 <= len(digits) <= 15 and len(digits) < len(span) <= 2 * len(digits) + 4 else None
    if kind == "id_number":
        value = re.sub(r"[^0-9A-Z]", "", span.upper())
        if re.fullmatch(r"\d{8}T\d{4,6}Z?", value):  # a point in time
            return None
        return (start, end, value) if 6 <= len(value) <= 20 and 5 <= len(digits) < len(span) and len(value) - len(digits) <= 4 else None
    if kind == "address":
        return (start, end, text[start:end]) if digits and re.search(rf"{_CAP}|{_HAN}{{2}}", span) and re.search(r"^\d|\d\w?$", span) and "\n" not in span else None
    return None


# What stands for the sign and the dots of a disguised address, with marks of any kind around it.
_LOOSE_AT = r"\s*[(\[{<]\s*(?:at|a)\s*[)\]}>]\s*|\s+at\s+|\s*@\s*"
_LOOSE_DOT = r"\s*[(\[{<]\s*(?:dot|d)\s*[)\]}>]\s*|\s+dot\s+"


def name_at(text: str, start: int, end: int) -> tuple[int, int, str] | None:
    """The name that a decoded span stands for: whole words, without titles; None if it has no name's shape."""
    letter = lambda c: (c.isalpha() or c in "'’-") and c < "⺀"
    while start > 0 and letter(text[start - 1]) and letter(text[start]):
        start -= 1
    while end < len(text) and letter(text[end - 1]) and letter(text[end]):
        end += 1
    span = text[start:end]
    lead = len(span) - len(span.lstrip(" \n\t,.:;—–-“\"'("))
    start, span = start + lead, span[lead:]
    if m := _TITLE.match(span):
        start, span = start + m.end(), span[m.end() :]
    if span and "一" <= span[0] <= "鿿":
        span = _HAN_TITLE.sub("", span)
        m = _HAN_NAME.fullmatch(span)
        return (start, start + len(span), span) if m else None
    if re.fullmatch(rf"{_WORD},", span.rstrip()) or re.fullmatch(_WORD, span.rstrip(" .,")):
        if m := re.compile(rf"{_WORD}, {_WORD}(?: [A-Z]\.)?").match(text, start):  # cut off after the family name
            return m.start(), m.end(), m[0]
    m = _LATIN_NAME.search(span)
    if not m:
        return None
    value = m[0]
    if _CONTRACTION.search(value):
        return None
    if text[start + m.end() : start + m.end() + 1] == "." and re.search(r" [A-Z]$", value):
        value += "."
    a, b = start + m.start(), start + m.start() + len(value)
    if value.isupper() and (_SHOUT_BEFORE.search(text, max(0, a - 30), a) or _SHOUT_AFTER.match(text, b)):
        return None  # words of a text in capitals
    return a, b, value


_CONTRACTION = re.compile(r"\w['’](?:d|ll|s|re|ve|m|t)\b")
_SHOUT_BEFORE = re.compile(r"[A-ZÀ-Þ]{3,},? +$")
_SHOUT_AFTER = re.compile(r",? +[A-ZÀ-Þ]{2,}\b(?! *[:=\d])")
