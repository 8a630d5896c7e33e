"""Problem 9: personal information inside free text.

Finds email addresses, phone numbers, identity numbers, street addresses and person names, and
replaces them by typed placeholders. Method: numbers that pass their format's check are replaced
by format-preserving pseudonyms: a keyed Feistel network permutes the digits and letters within the
format, walking on until the format's check holds again, so equal numbers stay linked across
documents and the placeholder shows no original. A phone keeps its country code and trunk prefix;
its national number alone is permuted, so all spellings of a number get the same one. Other kinds
carry a keyed code of 128 bits for the same reason. Every find comes with its placeholder.

Names are anchored by a list of given names (fixed ones and a parameter), by initials and titles,
and by structure: two or more capitalised words, particles between them, count as a name beside words
that introduce or follow persons, beside another name, or with a particle that only names have.

Every row is handled on its own where it is read: no shuffle, no state. Kinds are searched in a
fixed order (email, identity, phone, address, name); a found span is closed to later kinds.

Cases: null and empty texts give no rows and stay as they are; texts are read whole whatever
their length; a text under several ids is reported under each; positions count Unicode
characters; overlapping finds fall to the kind earlier in the order; words that announce another
kind of number count within 30 characters before it; other columns are ignored.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
import unicodedata
from base64 import b32encode
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from talespan.llm.tokens import slices
from talespan.runtime import materialize, spread

KINDS = ("email", "phone", "identity", "address", "name")

# Given names that anchor a person's name, beside those passed as a parameter.
GIVEN_NAMES = """
Aaltje Adriaan Albert Alfred Alice Andre André Anna Annie Anton Antje Arie Arthur Bernard Bertha Betsy Bram Cornelia Cornelis Dirk Dorothy
Edeltraud Edith Edward Elisabeth Elizabeth Elsa Emma Ernest Ernst Ethel Femke Florence Frank Frans Frederik Friedrich Fritz Geertje George
Gerard Gerda Gerrit Gertrud Gisela Greta Griet Günther Hannelore Hannah Hans Harold Heinrich Heinz Helga Hendrik Henk Herbert Hermann Hilde
Ilse Ingeborg Jacob Jan Jannie Jansje Joan Johanna Johannes Joop Josef Jürgen Karel Karl Kees Klaas Kurt Lena Leonard Liesel Lotte Maarten Mabel
Margaret Margarethe Maria Marie Marijke Martha Mary Mina Nel Nelly Neeltje Otto Paul Peter Piet Pieter Renée Richard Riet Robert Roelof Rosa
Saar Sara Sjoerd Sophie Stanley Teunis Theodor Thomas Trijntje Truus Ursula Walter Werner Wilhelm Wilhelmina Willem William Willy Wim
Winifred Wolfgang Wouter Zwaantje
""".split()

_U = "A-ZÀ-ÖØ-ÞĀĂĄĆČĎĐĒĖĘĚĞĢĪĮİĶĹĻĽŁŃŅŇŌŐŒŔŘŚŞŠŢŤŪŮŰŲŹŻŽ"
_L = r"[^\W\d_]"
_SP = r"\s{1,2}"
_WORD = rf"[{_U}](?:{_L}|[̀-ͯ'’])*"
_MASK = "￼"

_AT_SIGN = r"[\[({<]\s?(?:@|at|a|apenstaart(?:je)?|ät)\s?[\])}>]"
_AT_NAME = r"(?:apenstaart(?:je)?|klammeraffe)"
_DOT_NAME = r"(?:dot|punt|punkt)"
_AT = rf"(?:\s{{0,2}}(?:{_AT_SIGN}|@)\s{{0,2}}|\s{{1,2}}{_AT_NAME}\s{{1,2}})"
_DOT = r"(?:\.|\s{0,2}[\[({<]\s?(?:\.|dot|punt|punkt)\s?[\])}>]\s{0,2}|\s{1,2}(?:dot|punt|punkt)\s{1,2})"
_EMAIL = re.compile(rf"(?<![\w.+%-])[\w.+%-]*\w{_AT}\w[\w-]*(?:{_DOT}\w[\w-]*)*?{_DOT}[^\W\d_]{{2,}}(?![\w-]|{_DOT}\w)", re.I)
_EMAIL_AT_WORD = re.compile(rf"(?<![\w.+%-])[\w.+%-]*\w\s{{1,2}}at\s{{1,2}}\w[\w-]*(?:\s{{1,2}}{_DOT_NAME}\s{{1,2}}\w[\w-]*)+(?!\w)", re.I)
#: What every address holds beside a plain "@"; texts with neither are not searched.
_EMAIL_SIGN = re.compile(_AT_SIGN, re.I)
_EMAIL_WORD = re.compile(rf"\s(?:{_AT_NAME}\s|at\s{{1,2}}\w[\w-]*\s{{1,2}}{_DOT_NAME}\s)", re.I)

#: Part of the one identity form whose digits are no run of five or more.
_LETTERED = r"\d{2}[A-Z]\d{4}"
_IDENTITY = re.compile(
    rf"(?<![\w.,/+-])(?:"
    rf"(?P<ssn>\d{{3}}-\d{{2}}-\d{{4}})"
    rf"|(?P<bsn>\d{{9}}|\d{{3}}{_SP}\d{{3}}{_SP}\d{{3}}|\d{{4}}\.\d{{2}}\.\d{{3}}|\d{{4}}-\d{{5}}|\d{{3}}\.\d{{3}}\.\d{{3}})"
    rf"|(?P<card>[A-Z]\s?\d{{2}}(?:\s?/\s?|{_SP}n[or]\.?\s?)\d{{6}})"
    rf"|(?P<nino>[A-Z]{{2}}\s{{0,2}}\d{{2}}\s{{0,2}}\d{{2}}\s{{0,2}}\d{{2}}\s{{0,2}}[A-D])"
    rf"|(?P<pass>[A-Z]{{2}}\s{{0,2}}\d{{3}}\s{{0,2}}\d{{4}}|[A-Z]\d{{8}}|[A-Z]\d{{4}}-?\d{{3}}[A-Z]|[A-Z]{{2}}{_LETTERED})"
    rf")(?![\w]|[-/.]\d)".replace(r"\d", "[0-9]")
)
_NO_IDENTITY = re.compile(r"(?:inventar\w*|inventory\s+no\.?|inv\.?\s*(?:nr|no)\.?|isbn|issn|nummer\s+band|kaart|bestel\w*|rekening\w*|factuur\w*|signatu\w*|catalog\w*|toegang\w*)\s*:?\s*$", re.I)
_GAP = r"[ \xa0\n.\-/]{0,2}"
# Numbering plans: country code and national number, then national forms, longer groupings first.
_PHONE = re.compile(
    rf"(?<![\w.,/@+-])(?:"
    rf"(?:\+|00)31{_GAP}(?:\(0\))?(?:{_GAP}\d){{9}}(?!\d)"
    rf"|(?:\+|00)44{_GAP}(?:\(0\))?(?:{_GAP}\d){{10}}(?!\d)"
    rf"|(?:\+|00)1{_GAP}\(?\d{{3}}\)?{_GAP}\d{{3}}{_GAP}\d{{4}}(?!\d)"
    rf"|(?:\+|00)49{_GAP}(?:\(0\))?(?:(?:{_GAP}\d){{10}}|(?:{_GAP}\d){{11}}|(?:{_GAP}\d){{9}})(?!\d)"
    rf"|\+\d{{1,3}}(?:{_GAP}\(\d{{1,4}}\))?(?:{_GAP}\d){{7,12}}(?!\d)"
    rf"|06(?:{_GAP}\d){{8}}(?!\d)"
    rf"|(?:\(0\d{{2}}\)|0\d{{2}}){_GAP}(?:\d{{4}}{_GAP}\d{{4}}|\d{{5}}{_GAP}\d{{3}})(?!\d)"
    rf"|(?:\(0\d{{4}}\)|0\d{{4}}){_GAP}\d{{3}}{_GAP}\d{{3}}(?!\d)"
    rf"|(?:\(0\d{{3}}\)|0\d{{3}}){_GAP}\d{{7}}(?!\d)"
    rf"|(?:\(0\d{{2}}\)|0\d{{2}})(?:{_GAP}\d){{7}}(?!\d)"
    rf"|(?:\(0\d{{3}}\)|0\d{{3}})(?:{_GAP}\d){{6}}(?!\d)"
    rf"|(?:\(0\d{{2,4}}\)|0\d{{2,4}}){_GAP}\d{{6,8}}(?!\d)"
    rf"|[2-9]\d{{2}}-\d{{4}}(?!\d)"
    rf")(?![-/.:]\d|[^\W\d])".replace(r"\d", "[0-9]").replace("[^\\W[0-9]]", r"[^\W\d]")
)

_NL_SUFFIX = ("straat", "weg", "laan", "kade", "gracht", "plein", "dijk", "hof", "singel", "steeg", "pad", "markt", "haven", "wal", "hout",
              "straße", "strasse", "str.", "gasse", "allee", "Allee", "platz", "ufer", "ring", "damm", "park", "Straße", "Weg", "Gasse", "Platz")
_EN_SUFFIX = "Road|Street|Lane|Avenue|Close|Drive|Court|Terrace|Crescent|Place|Square|Gardens|Grove|Way|Row|Hill|Mews|Rd\\.?|St\\.?|Ave\\.?|Ln\\.?"
_NUMBER = re.compile(r"(?:\s{1,2}|^)([0-9]{1,4})(?![\d:%]|[.,][0-9])")
#: Digits with their signs; identity and phone numbers are searched around runs of five or more
#: and around digits with a letter between them.
_RUN = re.compile(r"[0-9](?:[0-9\s().\-/]*[0-9])?")
_LETTERED_RUN = re.compile(_LETTERED.replace(r"\d", "[0-9]"))
_HOUSE = re.compile(rf"\d{{1,4}}(?:{_SP}bis\b|\s?[a-zA-Z](?![\w'’])(?!\.\s?[A-Z]\.)|-(?:[IVX]{{1,4}}|\d{{1,3}}|[a-z])(?!\w)|/\d{{1,3}}(?!\w))?")
_STREET_HEAD = re.compile(
    rf"(?:(?:Oude|Korte|Nieuwe|Lange|Kleine|Grote|Eerste|Tweede|Alte|Neue|Kurze|Große|Am|An{_SP}der|An{_SP}den|Auf{_SP}dem|Im|Zum|Zur|Van|De|Het){_SP})?"
    rf"[{_U}](?:{_L}|['’.-])*$")
_TOWN = rf"[{_U}](?:{_L}|[̀-ͯ'’-])+"
_TOWN_TAIL = re.compile(
    rf"(?:,?\s{{1,2}}|\s?,\s?)\d{{4}}\s{{0,2}}[A-Z]{{2}}(?!\w)(?:,?{_SP}{_TOWN})?"
    rf"|\s{{1,2}}\(\d{{4}}\s{{0,2}}[A-Z]{{2}}(?:,?{_SP}{_TOWN})?\)"
    rf"|(?:,?\s{{1,2}}|\s?,\s?)\d{{5}}{_SP}{_TOWN}"
    rf"|\s{{1,2}}\(\d{{5}}(?:{_SP}{_TOWN})?\)"
    rf"|,?{_SP}(?:te|in){_SP}{_TOWN}"
    rf"|,{_SP}{_TOWN}(?:{_SP}[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_SP}\d[A-Z]{{2}}(?!\w))?"
)
_EN_ADDRESS = re.compile(
    rf"\d{{1,4}}[A-Za-z]?{_SP}(?:[{_U}](?:{_L}|['’-])+{_SP}){{1,3}}(?:{_EN_SUFFIX})(?!\w)"
    rf"(?:,{_SP}(?:{_TOWN}(?:{_SP}[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_SP}\d[A-Z]{{2}}(?!\w))?|[A-Z]{{1,2}}\d{{1,2}}[A-Z]?{_SP}\d[A-Z]{{2}}(?!\w)))?"
)
_FLAT = re.compile(rf"(?<!\w)(?:Flat|Apartment|Apt\.?|Unit){_SP}\d{{1,4}}[A-Za-z]?,?{_SP}$")

_PART = r"(?:(?:[Vv]an|VAN|[Vv]on|VON)(?:\s{1,2}(?:[Dd]er|DER|[Dd]en|DEN|[Dd]e|DE|[Hh]et|'t))?|[Dd]e|DE|[Dd]er|DER|[Dd]en|DEN|[Tt]en|TEN|[Tt]er|TER|zu|ZU|vom|VOM|[Oo]p{0}de)".replace("{0}", r"\s")
_INIT = r"(?:[A-Z]\.(?:\s?[A-Z]\.){0,3})"
_SUR = rf"(?!(?:INT|NARR)\b)[{_U}](?:{_L}|[̀-ͯ'’]){{2,}}(?:-[{_U}](?:{_L}|[̀-ͯ'’]){{2,}})?"
_TITLE = r"(?:[Dd]e\s{1,2}[Hh]eer|[Mm]evrouw|[Mm]evr\.|[Mm]w\.|[Dd]hr\.|[Mm]eneer|[Mm]ijnheer|[Hh]eer|Herrn?|Frau|Fräulein|Mrs?\.?|Ms\.?|Miss|Dr\.|Prof\.|[Dd]e\s[Hh]eer)"

def _trie_pattern(words: Iterable[str]) -> str:
    """A pattern that matches any of the words, sharing their beginnings."""
    root: dict = {}
    for w in words:
        node = root
        for c in w:
            node = node.setdefault(c, {})
        node[""] = {}

    def build(node: dict) -> str:
        ends = "" in node
        parts = [re.escape(c) + build(n) for c, n in sorted(node.items()) if c]
        if not parts:
            return ""
        body = parts[0] if len(parts) == 1 and not ends else "(?:" + "|".join(parts) + ")"
        return body + "?" if ends else body

    return build(root)


# Capitalised words that begin no name of a person; after a sentence's start or before a thing's own name.
_NO_NAME = """
Achter Als An Archief Auf Aus Bei Beste Bij Beyond By Can Could Daar Dan Das Dat De Dear Dein Dem Den Denn Der Des Dies Diese Die Dit Door Dort Ein Eine Einen Er Erinnern Es Euer
Foundation Für Gegen Geachte Gedenkstätte Hallo Have Het Hier His Hotel Huis Ich Ihr Im Institut Instituut Is Jede Jeden Jeder Kamp Kann Können Konzentrationslager Lager Liebe Lieber Maar Mein Met
Mijn Mit Mr Mrs Museum My Na Nach Naar Niet Noch Not Nu Of On Onder Ondertussen Ons Ook Op Oud Oude Our Over Rijks Royal Schule School Seine Sind Sehr Sie Sint So Stad Stadt Station Stichting Te Tegen
That The Their Then There They This To Toen Tot Und Uit Unser Van Veel Verein Vereniging Voor Vor Von Wat We Welche Wer What When Where Who Wie Wij Will Wir With Wo You Zu Zum Zur
Volgens Laut According Grüßen Groet Groeten Regards Wishes Contact Kontakt Dank Danke Thanks Redaktion Redactie Editors Kollegin Kollege Collega Colleague Kollegen Collega's
""".split()
_PARTS = rf"(?:{_PART}|[Ee]l|[Aa]l|[Bb]en|[Bb]in|[Ii]bn|[Dd]a|[Dd]i|[Dd]os|[Dd]el|[Dd]ella|[Ll]a|[Ll]e|[Dd]u)"
#: Particles that stand in names only, so that a pair with one needs no word beside it.
_NAME_PART = re.compile(r"\s(?:el|al|ben|bin|ibn|dos|della)\s")
_NOT = rf"(?!{_trie_pattern(_NO_NAME)}\b)"
_FIRST = rf"[{_U}](?:{_L}|[̀-ͯ'’-])+"
_PAIR = re.compile(
    rf"{_NOT}(?:{_FIRST}(?:{_SP}{_INIT})?(?:{_SP}{_PARTS})?{_SP}{_NOT}{_SUR}(?!{_SP}(?:{_EN_SUFFIX})\b)|{_SUR},{_SP}{_NOT}{_FIRST}(?:{_SP}{_INIT})?(?:{_SP}{_PART}(?!\w))?)(?![\w’'])")
_BEFORE_INITIAL = re.compile(rf"(?<![\w.@’'-]){_NOT}{_FIRST}{_SP}$")
#: Words that introduce a person, or a name beside it (masked here), right before the pair.
_INTRODUCES = re.compile(
    rf"(?:\b(?:heette|heet|heten|genaamd|genoemd|noemt|noemde|named|called|mentions|mentioned|hieß|heißt|namens|nennt|nannte|volgens|according\s+to|laut|contact|kontakt|contactpersoon|"
    rf"ondertekend\s+door|signed\s+by|nagekeken\s+door|checked\s+by|geprüft\s+von|geschreven\s+door|written\s+by|interview(?:ed)?\s+(?:met|with|mit|by)|gesprek\s+met|talked\s+to|spoke\s+(?:to|with)|"
    rf"sprak\s+met|sprach\s+mit|kleinkind|grandchild|enkelkind|(?:groot)?vader|(?:groot)?moeder|(?:grand)?father|(?:grand)?mother|broer|zus(?:ter)?|brother|sister|bruder|schwester|neef|nicht|oom|tante|uncle|aunt|"
    rf"bij|met|naast|with|by|next\s+to|beside|bei|mit|neben|bitte\s+an|to|home\s+of|ring|call|bel|shows|staan|staat|sieht\s+man|kunt\s+u|dochter|zoon|daughter|son|tochter|sohn|vriend(?:in)?|friend|buurman|buurvrouw|neighbou?r|collega|colleague|kolleg(?:e|in)|groet(?:en)?|regards|wishes|grüßen|beste|dear|liebe[rs]?|geachte)|"
    rf"{_MASK}(?:,|\s{{1,2}}(?:en|and|und))|(?:^|\n)\s*(?:naam|name))\s*[:,]?\s{{1,3}}$", re.I)
_ADDRESSES = re.compile(r"\b(?:beste|dear|liebe[rs]?|geachte|geehrter?)\s{1,3}$", re.I)
_FOLLOWS = re.compile(
    r"\s{1,2}(?:bellen|thuis|wil|wishes|möchte|called|zei|zegt|vertelde|vertelt|overleed|belde|weet|wist|schreef|werd\s+geboren|is\s+geboren|said|says|told|tells|died|knows|knew|wrote|was\s+born|sagte|sagt|erzählt|erzählte|starb|weiß|wusste|schrieb|rief|wurde\s+geboren)\b"
    rf"|,?\s{{1,2}}(?:geboren|born|geb\.)\s|\s{{1,2}}(?:en|and|und)\s{{1,2}}{_MASK}")
#: Characters around a pair in which such words are looked for; longer than any of them.
_BESIDE = 48


def _forms(given: Iterable[str]) -> set[str]:
    """The spellings in which given names are looked for: as they are, without accents, in
    capitals, with accents as signs of their own."""
    names = {unicodedata.normalize("NFC", n) for n in given if n and len(n) > 2 and n[0].isupper()}
    plain = {"".join(c for c in unicodedata.normalize("NFKD", n) if not unicodedata.combining(c)) for n in names}
    return names | plain | {n.upper() for n in names | plain} | {unicodedata.normalize("NFD", n) for n in names}


class Finder:
    """Finds the spans of one text. ``given``: further given names."""

    def __init__(self, given: Iterable[str] = ()):
        forms = _forms([*GIVEN_NAMES, *given])
        g = f"(?:{_trie_pattern(forms)})(?![\\w’'])"
        # Where a name or title may begin; only there the patterns are tried.
        first = f"[{_U}dmh{''.join(sorted({re.escape(n[0]) for n in forms}))}]"
        self.start = re.compile(rf"{first}(?<![\w.@’'-]{first})")
        # (?!_SUR) after "Surname, Given" keeps "Town, Given Surname" from being read as reversed.
        self.name = re.compile(
            rf"(?:"
            rf"(?P<rev>{_SUR},{_SP}(?:{g}(?:{_SP}{_INIT})?|{_INIT})(?:{_SP}{_PART}(?![\w]))?(?!{_SP}(?:{_INIT}\s)?(?:{_PART}{_SP})?{_SUR}))"
            rf"|{g}(?:{_SP}{_INIT})?(?:(?:{_SP}{_PART})?{_SP}{_SUR}|{_SP}{_SUR})?"
            rf"|{_INIT}{_SP}(?:{_PART}{_SP})?{_SUR}"
            rf"|{_TITLE}{_SP}(?P<title>(?:{_INIT}{_SP})?(?:{_PART}{_SP})?{_SUR})"
            rf")")

    def find(self, text: str) -> list[tuple[int, int, str]]:
        """(start, end, kind) of all finds, in order."""
        found: list[tuple[int, int, str]] = []
        work = text
        if "@" in text or _EMAIL_SIGN.search(text) or _EMAIL_WORD.search(text):
            for pattern in (_EMAIL, _EMAIL_AT_WORD):
                work = self._take(work, pattern.finditer(work), "email", found)
        if runs := [m.span() for m in _RUN.finditer(work)]:
            work = self._numbers(work, runs, found)
            streets = self._addresses(work)
            found += streets
            work = self._mask(work, streets)
        starts = [m.start() for m in self.start.finditer(work)]
        names, at = [], 0
        for start in starts:
            if start < at or not (m := self.name.match(work, start)):
                continue
            s, at = m.span("title") if m["title"] else m.span()
            # A given name that is not listed may stand before the initials.
            if text[s + 1:s + 2] == "." and (first := _BEFORE_INITIAL.search(work, _words_before(work, s, 1), s)):
                s = first.start() if first.start() >= (names[-1][1] if names else 0) else s
            names.append((s, at, "name"))
        found += names
        found += self._by_structure(self._mask(work, names), starts)
        found.sort()
        return found

    @staticmethod
    def _by_structure(text: str, starts: list[int]) -> list[tuple[int, int, str]]:
        """Names that only their structure and the words beside them tell."""
        out, at = [], 0
        for start in starts:
            if start < at or not (m := _PAIR.match(text, start)):
                continue
            s, e = m.span()
            beside = text[max(0, s - _BESIDE):s]
            # "Dear colleague, Later we ...": what follows the comma of an address is no given name.
            if "," in m[0] and _ADDRESSES.search(beside):
                continue
            if _NAME_PART.search(text, s, e) or _INTRODUCES.search(beside) or _FOLLOWS.match(text, e):
                out.append((s, e, "name"))
                text = text[:s] + _MASK * (e - s) + text[e:]
                at = e
        return out

    @staticmethod
    def _mask(text: str, spans: list[tuple[int, int, str]]) -> str:
        if not spans:
            return text
        out, at = [], 0
        for s, e, _ in sorted(spans):
            out += [text[at:s], _MASK * (e - s)]
            at = e
        return "".join([*out, text[at:]])

    def _take(self, text: str, matches, kind: str, found: list) -> str:
        spans = [(m.start(), m.end(), kind) for m in matches]
        found += spans
        return self._mask(text, spans)

    def _numbers(self, text: str, runs: list[tuple[int, int]], found: list) -> str:
        """Adds identity numbers, then phones, around runs of five or more digits or with a
        letter; returns the masked text."""
        long = [(s, e) for s, e in runs if e - s >= 5 and sum(map(str.isdigit, text[s:e])) >= 5]
        if lettered := [m.span() for m in _LETTERED_RUN.finditer(text)]:
            long = sorted(long + lettered)
        if not long:
            return text
        for kind in ("identity", "phone"):
            spans, at = [], 0
            for s, e in long:
                lo, hi = max(at, s - 12), min(len(text), e + 4)
                while lo < hi and (m := (_IDENTITY if kind == "identity" else _PHONE).search(text, lo, min(len(text), hi + 40))):
                    if m.start() >= hi:
                        break
                    if self._is_identity(text, m) if kind == "identity" else self._is_phone(text, m):
                        spans.append((m.start(), m.end(), kind))
                        lo = at = m.end()
                    else:
                        lo = m.start() + 1
            found += spans
            text = self._mask(text, spans)
        return text

    @staticmethod
    def _is_identity(text: str, m: re.Match) -> bool:
        kind = m.lastgroup
        if kind == "bsn":
            digits = [int(c) for c in m[0] if c.isdigit()]
            if not eleven_test(digits):
                return False
        return not _NO_IDENTITY.search(text, max(0, m.start() - 30), m.start())

    @staticmethod
    def _is_phone(text: str, m: re.Match) -> bool:
        digits = sum(map(str.isdigit, m[0]))
        return digits in (7, *range(9, 16)) and not _NO_IDENTITY.search(text, max(0, m.start() - 30), m.start())

    @staticmethod
    def _addresses(text: str) -> list[tuple[int, int, str]]:
        out, at = [], 0
        for m in _NUMBER.finditer(text):
            if m.start() < at:
                continue
            if full := _EN_ADDRESS.match(text, m.start(1)):
                flat = _FLAT.search(text, max(at, m.start(1) - 24), m.start(1))
                at = full.end()
                out.append((flat.start() if flat else m.start(1), at, "address"))
            elif text.endswith(_NL_SUFFIX, 0, m.start()):
                head = _STREET_HEAD.search(text, _words_before(text, m.start(), 3), m.start())
                house = _HOUSE.match(text, m.start(1))
                if head and house and len(head[0]) >= 5:
                    tail = _TOWN_TAIL.match(text, house.end())
                    at = tail.end() if tail else house.end()
                    out.append((head.start(), at, "address"))
        return out


def _words_before(text: str, at: int, n: int) -> int:
    """Where the n words before a place begin."""
    for _ in range(n):
        while at and text[at - 1].isspace():
            at -= 1
        while at and not text[at - 1].isspace():
            at -= 1
    return at


def eleven_test(digits: list[int]) -> bool:
    """The check of nine-digit citizen numbers."""
    return len(digits) == 9 and any(digits) and (sum(d * w for d, w in zip(digits, range(9, 1, -1))) - digits[8]) % 11 == 0


_DATE = re.compile(r"(?P<y1>[0-9]{4})(?P<s1>[-/.])(?P<m1>[0-9]{1,2})(?P=s1)(?P<d1>[0-9]{1,2})|(?P<d2>[0-9]{1,2})(?P<s2>[-/.])(?P<m2>[0-9]{1,2})(?P=s2)(?P<y2>[0-9]{4})")
_DATE_IN_TEXT = re.compile(rf"(?<![\w./-])(?:{_DATE.pattern})(?![\w/-]|\.[0-9])")


class Feistel:
    """Keyed permutation of the values of a format, by alternating modular Feistel rounds. A format
    is a radix per place: 10 for a digit, 26 for a letter, fewer where fewer letters are allowed."""

    ROUNDS = 8

    def __init__(self, key: str):
        self.key = hashlib.blake2b(key.encode(), digest_size=32).digest()

    def _round(self, r: int, size: int, half: int) -> int:
        # 16 bytes beyond the half's own size, so that the modulo is even to within 2**-128.
        n = max(1, (half.bit_length() + 7) // 8)
        h = hashlib.blake2b(b"%d|%d|" % (r, size) + half.to_bytes(n, "big"), key=self.key, digest_size=min(64, 16 + (size.bit_length() + 7) // 8)).digest()
        return int.from_bytes(h, "big")

    def permute_places(self, values: list[int], radices: list[int]) -> list[int]:
        """The permuted value of every place."""
        if not values:
            return []
        cut = len(values) // 2
        sizes = math.prod(radices[:cut]), math.prod(radices[cut:])
        halves = []
        for lo, hi in ((0, cut), (cut, len(values))):
            x = 0
            for v, r in zip(values[lo:hi], radices[lo:hi]):
                x = x * r + v
            halves.append(x)
        whole = sizes[0] * sizes[1]
        for r in range(self.ROUNDS):
            k = r % 2
            halves[k] = (halves[k] + self._round(r, whole, halves[1 - k])) % sizes[k]
        out = []
        for k, part in ((1, radices[cut:]), (0, radices[:cut])):
            x = halves[k]
            for r in reversed(part):
                x, v = divmod(x, r)
                out.append(v)
        return out[::-1]

    def permute(self, digits: str) -> str:
        return "".join(map(str, self.permute_places([int(c) for c in digits], [10] * len(digits))))

    def in_format(self, text: str, valid: Callable[[list[int]], bool] | None = None, last_letter: int = 26) -> str:
        """The text with its digits and capital letters permuted together, whatever signs stand
        between them; walks on until ``valid`` holds for the places. ``last_letter``: how many
        letters the last place may have."""
        spots = [i for i, c in enumerate(text) if c in _ALNUM]
        values = [_ALNUM[text[i]] for i in spots]
        radices = [10 if text[i].isdigit() else 26 for i in spots]
        if spots and radices[-1] == 26 and values[-1] < last_letter:
            radices[-1] = last_letter
        new = self.permute_places(values, radices)
        while valid is not None and not valid(new):
            new = self.permute_places(new, radices)
        out = list(text)
        for i, v in zip(spots, new):
            out[i] = str(v) if text[i].isdigit() else chr(65 + v)
        return "".join(out)

    def phone(self, text: str) -> str:
        """A phone number with its national number permuted: country code and trunk prefix stay, and
        a number that does not begin with 0 keeps to such numbers."""
        at = _prefix(text)
        rest = text[at:]
        first = next((c for c in rest if c.isdigit()), "0")
        return text[:at] + self.in_format(rest, (lambda v: v[0] != 0) if first != "0" else None)

    def date(self, text: str) -> str:
        """A numeric date permuted among the days of 1700 to 2199, in its own notation (order,
        signs, leading zeros); text that is no such date stays."""
        m = _DATE.fullmatch(text)
        if not m:
            return text
        sign = m["s1"] or m["s2"]
        year, month, day = (int(m[x + "1"] or m[x + "2"]) for x in "ymd")
        first, last = datetime.date(1700, 1, 1).toordinal(), datetime.date(2199, 12, 31).toordinal()
        try:
            at = datetime.date(year, month, day).toordinal()
        except ValueError:
            return text
        if not first <= at <= last:
            return text
        at -= first
        while True:
            at = int(self.permute(f"{at:06d}"))
            if at <= last - first:
                break
        new = datetime.date.fromordinal(at + first)
        width = 2 if all(len(m[x]) == 2 for x in ("m1", "d1") if m[x]) and all(len(m[x]) == 2 for x in ("m2", "d2") if m[x]) else 1
        parts = [f"{new.day:0{width}d}", f"{new.month:0{width}d}", f"{new.year:04d}"]
        return sign.join(parts[::-1] if m["y1"] else parts)

    def code(self, kind: str, text: str) -> str:
        plain = " ".join(unicodedata.normalize("NFKC", text).casefold().split())
        return b32encode(hashlib.blake2b(f"{kind}|{plain}".encode(), key=self.key, digest_size=16).digest()).decode().rstrip("=").lower()


_ALNUM = {str(d): d for d in range(10)} | {chr(65 + k): k for k in range(26)}
#: Country codes of one and of two digits; all others have three.
_SHORT_CODES = ("1", "7")
_CODES = {"20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "53", "54", "55", "56", "57", "58",
          "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "92", "93", "94", "95", "98"}
_TRUNK = re.compile(r"[^0-9]*\(0\)|[^0-9]*0(?!0)")
_NINO = re.compile(r"[A-Z]{2}[0-9]{6}[A-D]")


def _prefix(text: str) -> int:
    """How many characters of a phone number are country code and trunk prefix."""
    at = 0
    if m := re.match(r"[^0-9+]*(?:\+|00)[^0-9]*", text):
        digits = "".join(c for c in text[m.end():] if c.isdigit())
        n = 1 if digits.startswith(_SHORT_CODES) else 2 if digits[:2] in _CODES else 3
        at = m.end()
        while n and at < len(text):
            n -= text[at].isdigit()
            at += 1
    if m := _TRUNK.match(text, at):
        at = m.end()
    return at


def placeholder(feistel: Feistel, kind: str, text: str) -> str:
    """The typed placeholder of a found text. The country code and trunk prefix of a phone stay; all
    other digits and the letters of numbers are permuted within their format."""
    if kind == "identity":
        digits = [int(c) for c in text if c.isdigit()]
        plain = "".join(c for c in text if c in _ALNUM)
        letters = 4 if _NINO.fullmatch(plain) else 26
        announced = re.sub(r"\bn[or]\b\.?", lambda m: m[0].lower(), text)
        return f"[IDENTITY {feistel.in_format(announced, eleven_test if len(plain) == 9 and eleven_test(digits) else None, letters)}]"
    if kind == "phone":
        return f"[PHONE {feistel.phone(text)}]"
    return f"[{kind.upper()} {feistel.code(kind, text)}]"


#: Given names up to which one pattern holds them all; more are joined to the documents that hold them.
MOST_NAMES = 200_000


def given_names(*columns: tuple[DataFrame, str]) -> DataFrame:
    """Distinct first words of full-name columns that look like given names: n."""
    found = None
    for df, col in columns:
        first = df.select(F.regexp_extract(col, r"^\s*(\p{Lu}[\p{L}\p{M}]{2,})\s", 1).alias("n")).where("n <> ''")
        found = first if found is None else found.unionByName(first)
    return found.distinct()


def _with_names(documents: DataFrame, id_col: str, text_col: str, given: DataFrame | Iterable[str] | None, most: int):
    """(rows: id, text, names of the text's own; names for all texts)."""
    rows = documents.select(id_col, text_col)
    if given is None or not isinstance(given, DataFrame):
        return rows.withColumn("_own", F.lit(None).cast("array<string>")), sorted(set(given or ()))
    if given.limit(most + 1).count() <= most:
        return rows.withColumn("_own", F.lit(None).cast("array<string>")), sorted(r[0] for r in given.collect())
    # Too many for one pattern: each text gets those that it holds, in any of the forms searched.
    rows = materialize(rows.withColumn("_row", F.monotonically_increasing_id()), "pii-rows")
    words = rows.select("_row", F.explode(F.array_distinct(F.regexp_extract_all(text_col, F.lit(r"(\p{Lu}[\p{L}\p{M}]{2,})"), 1))).alias("w"))

    def spell(batches):
        for batch in batches:
            pairs = [(n, w) for n in batch.column(0).to_pylist() for w in _forms([n])]
            yield pa.RecordBatch.from_arrays([pa.array([n for n, _ in pairs], pa.string()), pa.array([w for _, w in pairs], pa.string())], names=["n", "w"])

    held = words.join(given.select("n").mapInArrow(spell, "n string, w string"), "w").groupBy("_row").agg(F.collect_set("n").alias("_own"))
    return rows.join(held, "_row", "left").select(id_col, text_col, "_own"), []


def _with_dates(text: str, spans: list[tuple[int, int, str]]) -> list[tuple[int, int, str]]:
    """The finds and the numeric dates outside of them, in order."""
    taken = Finder._mask(text, spans)
    return sorted([*spans, *((m.start(), m.end(), "date") for m in _DATE_IN_TEXT.finditer(taken))])


class _Finders:
    """The finder for all texts, and those for texts with names of their own (a few are kept)."""

    def __init__(self, given: list[str]):
        self.given, self.all, self.own = given, Finder(given), {}

    def find(self, text: str, own: list[str] | None):
        if not own:
            return self.all.find(text)
        key = frozenset(own)
        if key not in self.own:
            if len(self.own) > 1000:
                self.own.clear()
            self.own[key] = Finder([*self.given, *own])
        return self.own[key].find(text)


def find_personal(documents: DataFrame, given: DataFrame | Iterable[str] | None = None, key: str = "", id_col: str = "doc_id", text_col: str = "text", most: int = MOST_NAMES) -> DataFrame:
    """One row per occurrence: id_col, start_pos, end_pos, pii_type, placeholder. ``given``: further
    given names, a list or a frame with column n."""
    kind = documents.schema[id_col].dataType.simpleString()
    rows, given = _with_names(documents, id_col, text_col, given, most)

    def run(batches):
        finders, feistel = _Finders(given), Feistel(key)
        for batch in batches:
            for part in slices(batch, 1):
                take, start, end, kinds, instead = [], [], [], [], []
                for i, (text, own) in enumerate(zip(part.column(1).to_pylist(), part.column(2).to_pylist())):
                    if text:
                        for s, e, k in finders.find(text, own):
                            take.append(i)
                            start.append(s)
                            end.append(e)
                            kinds.append(k)
                            instead.append(placeholder(feistel, k, text[s:e]))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(take, pa.int32())), pa.array(start, pa.int32()), pa.array(end, pa.int32()), pa.array(kinds, pa.string()), pa.array(instead, pa.string())],
                    names=[id_col, "start_pos", "end_pos", "pii_type", "placeholder"])

    return spread(rows).mapInArrow(run, f"`{id_col}` {kind}, start_pos int, end_pos int, pii_type string, placeholder string")


def redact(documents: DataFrame, key: str, given: DataFrame | Iterable[str] | None = None, id_col: str = "doc_id", text_col: str = "text", dates: bool = False, most: int = MOST_NAMES) -> DataFrame:
    """Every row with its text redacted: id_col, text, n_found. Equal values get equal
    placeholders in all documents under one key. ``dates`` also permutes numeric dates, which
    are else left as they are."""
    kind = documents.schema[id_col].dataType.simpleString()
    rows, given = _with_names(documents, id_col, text_col, given, most)

    def run(batches):
        finders, feistel = _Finders(given), Feistel(key)
        for batch in batches:
            for part in slices(batch, 1):
                texts, counts = [], []
                for text, own in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    spans = finders.find(text, own) if text else []
                    counts.append(len(spans))
                    if dates and text:
                        spans = _with_dates(text, spans)
                    if spans:
                        out, at = [], 0
                        for s, e, k in spans:
                            out += [text[at:s], feistel.date(text[s:e]) if k == "date" else placeholder(feistel, k, text[s:e])]
                            at = e
                        text = "".join([*out, text[at:]])
                    texts.append(text)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array(counts, pa.int32())], names=[id_col, "text", "n_found"])

    return spread(rows).mapInArrow(run, f"`{id_col}` {kind}, text string, n_found int")
