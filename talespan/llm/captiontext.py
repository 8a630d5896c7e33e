"""Reading of caption texts: speaker labels, times, sounds, hesitations, markup, words.

One pass over a caption yields pieces ``(speaker, words)``: ``speaker`` is the number a label
set at that place, None where none did. Everything is row-local; the speaker that goes on from
earlier captions is added by the operators (see turns.py and runs.py).
"""

from __future__ import annotations

import html
import re
import unicodedata

# General words that label the asking and the interviewed person.
ASKING = ("interviewer", "interviewster", "interviewerin", "int", "i", "q", "vraag", "vragensteller", "frage", "question", "fragender")
TELLING = ("narrator", "narr", "n", "a", "antwoord", "antwort", "answer", "geinterviewde", "geint", "verteller", "vertelster",
           "erzahler", "erzahlerin", "interviewee", "respondent", "befragter", "befragte", "spreekster")
TITLES = {"dhr", "mw", "mevr", "mevrouw", "meneer", "mijnheer", "heer", "mr", "mrs", "ms", "miss", "herr", "frau", "dr", "prof", "ds"}
PARTICLES = {"van", "von", "de", "der", "den", "het", "ten", "ter", "te", "op", "zu", "vom", "la", "le", "t"}

HESITATION = re.compile(r"(?:e+h+m*|e+h*m+h*|u+h+m*|u+m{2,}|h+m+|m{2,}|ä+h*m*h*|a+h+m+|ö+h+m*)")
_NUMBERED = re.compile(r"(?:s|sp|spr|spk|speaker|spreker|sprecher|sprecherin|persoon|person|stem|voice)[\s_#.\-]*0*(\d{1,3})")
_TIME = r"\d{1,3}:\d{2}(?::\d{2})?(?:[.,]\d{1,3})?"
_SPECIAL = re.compile(r"[\[\](){}<>*:&]")
# In order: voice tag, markup tag, bracketed text, starred text. A bracket may hold a time, a label or a sound.
_SCAN = re.compile(
    r"<v(?:\.[\w.]+)?\s+(?P<voice>[^<>]*)>"
    r"|(?P<tag></?(?:i|b|u|v|c|em|strong|ruby|rt|font|lang|span)(?:[.\s][^<>]*)?/?>)"
    r"|\[(?P<sq>[^\[\]]*)\]|\((?P<rd>[^()]*)\)|\{(?P<cu>[^{}]*)\}|<(?P<an>[^<>]*)>"
    r"|\*\*(?P<s2>[^*]*)\*\*|\*(?P<s1>[^*\n]*)\*",
    re.I,
)
_LINE_TIME = re.compile(rf"(^|\n|\x00|[.?!…][ \xa0])(\s*(?:[-–—•]\s+)?){_TIME}(?=\s|$)")
_CLOCK_TIME = re.compile(r"(?<!\S)\d{1,3}:\d{2}:\d{2}(?:[.,]\d{1,3})?(?!\S)")
_COLON = re.compile(r":(?=\s|\x00|$)")
_MARK = re.compile(r"\x00(-?\d+)\x00")
_LEAD = "-–—•>»·"


def strip_accents(s: str) -> str:
    if s.isascii():
        return s
    return "".join(c for c in unicodedata.normalize("NFKD", s) if not unicodedata.combining(c))


def fold(s: str) -> str:
    """Lower case without accents, punctuation as blanks, single blanks."""
    s = strip_accents(unicodedata.normalize("NFKC", s).casefold())
    return " ".join(re.sub(r"[^\w]+|_", " ", s).split())


def osa_within(a: str, b: str, limit: int) -> bool:
    """Whether two strings are within ``limit`` insertions, deletions, substitutions, swaps."""
    return osa(a, b, limit) <= limit


def osa(a: str, b: str, limit: int = 99) -> int:
    """Optimal string alignment distance; ``limit + 1`` once it exceeds the limit."""
    if a == b:
        return 0
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    while a and b and a[0] == b[0]:
        a, b = a[1:], b[1:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    if not a or not b:
        return len(a) or len(b)
    before, last = None, list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            d = min(last[j] + 1, row[-1] + 1, last[j - 1] + (x != y))
            if before is not None and j > 1 and x == b[j - 2] and a[i - 2] == y:
                d = min(d, before[j - 2] + 1)
            row.append(d)
        if min(row) > limit and (before is None or min(last) > limit):
            return limit + 1
        before, last = last, row
    return last[-1]


class WordTable:
    """Cache from raw pieces to normalised words; None for pieces that are no word.

    Bounded: emptied when it holds ``limit`` pieces, which only costs time.
    """

    def __init__(self, limit: int = 200_000):
        self.limit, self.known = limit, {}

    def get(self, piece: str):
        try:
            return self.known[piece]
        except KeyError:
            pass
        word = unicodedata.normalize("NFC", piece).casefold()
        core = "".join(c for c in word if c.isalnum())
        if not core or HESITATION.fullmatch(core):
            word = None
        else:
            word = "".join(c for c in strip_accents(word) if c.isalnum()) or core
        if len(self.known) >= self.limit:
            self.known.clear()
        self.known[piece] = word
        return word


class Labels:
    """Resolves label texts of one tape to speaker numbers.

    ``speakers``: (speaker_no, full_name) pairs. Names count as full name, surname with or
    without particles and titles, given name, or initials; a form that two speakers share
    resolves to nobody.
    """

    GENERIC = {**{w: 1 for w in ASKING}, **{w: 2 for w in TELLING}}
    FUZZY = [(w, n) for w, n in GENERIC.items() if len(w) >= 7]

    def __init__(self, speakers=()):
        forms: dict[str, set[int]] = {}
        for no, name in speakers:
            parts = fold(name or "").split()
            if not parts:
                continue
            own = {" ".join(parts), "".join(p[0] for p in parts)}
            if len(parts) > 1:
                rest = parts[1:]
                core = [p for p in rest if p not in PARTICLES] or rest
                own |= {" ".join(rest), " ".join(core), parts[0], core[-1], f"{parts[0]} {core[-1]}",
                        f"{core[-1]} {parts[0]}", parts[0][0] + core[-1][0], f"{parts[0][0]} {' '.join(rest)}",
                        " ".join(p[0] for p in parts)}
            for f in own:
                forms.setdefault(f, set()).add(int(no))
        self.names = {f: next(iter(n)) for f, n in forms.items() if len(n) == 1}
        #: Words that a label before a colon may have: the longest name with titles before it.
        self.most_words = 3 + max([3, *(f.count(" ") + 1 for f in self.names)])
        self.known: dict[str, int | None] = {}

    def get(self, text: str) -> int | None:
        try:
            return self.known[text]
        except KeyError:
            pass
        if len(self.known) > 50_000:
            self.known.clear()
        got = self._resolve(text)
        if len(text) <= 200:  # long ones are read anew each time, so the cache stays small
            self.known[text] = got
        return got

    def _resolve(self, text: str) -> int | None:
        s = fold(text)
        if not s:
            return None
        if s in self.GENERIC:
            return self.GENERIC[s]
        if m := _NUMBERED.fullmatch(s):
            return int(m[1])
        if s in self.names:
            return self.names[s]
        parts = s.split()
        while parts and parts[0] in TITLES or parts[:2] == ["de", "heer"]:
            parts = parts[1:]
        s = " ".join(parts)
        if s in self.names:
            return self.names[s]
        if len(parts) == 1 and len(s) >= 6:
            near = sorted((osa(s, w, 2), n) for w, n in self.FUZZY)
            if near and near[0][0] <= 2:
                return near[0][1]
        if len(s) >= 6:
            near = {n for w, n in self.names.items() if len(w) >= 6 and w[0] == s[0] and osa(s, w, 1) <= 1}
            if len(near) == 1:
                return next(iter(near))
        return None


def pieces(text: str, labels: Labels, words: WordTable) -> list[tuple[int | None, list[str]]]:
    """The pieces of one caption: ``[(speaker set here or None, raw word pieces), ...]``.

    The first piece is what precedes any label; its speaker is None. Null text gives one
    empty piece.
    """
    if not text:
        return [(None, [])]
    get = words.get
    if not _SPECIAL.search(text):
        return [(None, [p for p in text.split() if get(p) is not None])]
    if "&" in text:
        text = html.unescape(text)
    if _SCAN.search(text):
        text = _SCAN.sub(lambda m: _replace(m, labels), text)
    if ":" in text:
        text = _CLOCK_TIME.sub("\n", _LINE_TIME.sub(r"\1\2 ", text))
        text = _colon_labels(text, labels)
    if "\x00" not in text:
        return [(None, [p for p in text.split() if get(p) is not None])]
    split = _MARK.split(text)
    out = [(None, [p for p in split[0].split() if get(p) is not None])]
    for i in range(1, len(split), 2):
        out.append((int(split[i]), [p for p in split[i + 1].split() if get(p) is not None]))
    return out


def _replace(m: re.Match, labels: Labels) -> str:
    kind = m.lastgroup
    if kind == "tag":
        return ""
    inner = m[kind]
    if kind in ("s1", "s2"):
        return " "
    if kind == "voice" or kind in ("sq", "rd", "an"):
        no = labels.get(inner)
        if no is not None:
            return f"\x00{no}\x00"
    return " "


def _colon_labels(text: str, labels: Labels) -> str:
    """Replace ``label:`` at the start of an utterance by its mark; other colons stay."""
    out, at = [], 0
    for m in _COLON.finditer(text):
        end = m.start()
        if end and text[end - 1] == "\x00":  # "[INT]:", already marked
            out.append(text[at:end])
            at = end + 1
            continue
        head = text[at:end]
        spans = [(t.start(), t.group()) for t in re.finditer(r"[^\s\x00]+", head)][-labels.most_words:]
        found = None
        for k, (start, token) in enumerate(spans):
            clean = token.lstrip(_LEAD)
            if not clean:
                continue
            before = head[:start].rstrip(" \t" + _LEAD)
            lead = token[: len(token) - len(clean)]
            opens = (not before or before[-1] in "\n\x00.?!…\"'”" or "\n" in head[len(before):start]
                     or ">" in lead or head[len(before):start].strip(" \t") != "")
            if not opens:
                continue
            no = labels.get(head[start:].lstrip(_LEAD))
            if no is not None:
                found = (start, no)
                break
        if found:
            out.append(head[: found[0]] + f"\x00{found[1]}\x00")
            at = end + 1
    out.append(text[at:])
    return "".join(out)
