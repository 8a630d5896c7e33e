"""Text expressions, all evaluated inside the JVM unless noted."""

from __future__ import annotations

import html
import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType


def strip(col: Column) -> Column:
    """Without white space of any kind at both ends (trim() strips blanks only)."""
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def flatten(col: Column) -> Column:
    """One line: newlines become blanks, ends are stripped."""
    return strip(F.replace(col, F.lit("\n"), F.lit(" ")))


def says(col: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(col, F.lit("")) != ""


def concept_label(name: Column, description: Column) -> Column:
    """``name – description``, or the name alone."""
    return F.when(says(description), F.concat(name, F.lit(" – "), description)).otherwise(name)


def concept_text(name: Column, alternate_names: Column, description: Column) -> Column:
    """The text that is embedded for a concept: name | alternatives | description."""
    return F.concat_ws(" | ", name, F.when(F.size(alternate_names) > 0, F.array_join(alternate_names, " / ")), F.when(says(description), description))


@F.pandas_udf(StringType())
def two_decimals(x: pd.Series) -> pd.Series:
    """Exact binary rounding to two decimals; the JVM's formatter rounds the decimal rendering."""
    return x.map(lambda v: None if v is None or v != v else f"{v:.2f}")


def caption_line(idx: Column, start: Column, text: Column) -> Column:
    """``[index][start in seconds] text`` as prompts show a caption."""
    return F.concat(F.lit("["), idx.cast("string"), F.lit("]["), two_decimals(start), F.lit("s] "), flatten(text))


def timestamp_seconds(col: Column) -> Column:
    """Seconds of ``[[h:]m:]s.ms``: a dot counts as a colon, missing leading parts are 0, the last
    part is milliseconds. Null where a part is no whole number or there are more than four."""
    parts = F.split(F.replace(strip(col), F.lit("."), F.lit(":")), ":")
    n = F.size(parts)
    number = lambda from_end: F.when(n >= from_end, strip(F.get(parts, n - from_end)).try_cast("bigint")).otherwise(0)
    h, m, s, ms = (number(k) for k in (4, 3, 2, 1))
    return F.when((n <= 4) & col.isNotNull(), (h * 3600 + m * 60 + s).cast("double") + ms.cast("double") / F.lit(1000).cast("double"))


def cue_times(line: Column) -> Column:
    """struct(start, end) in seconds of a cue timing line with exactly one arrow, else nulls."""
    sides = F.split(line, "-->")
    ok = F.size(sides) == 2
    return F.struct(F.when(ok, timestamp_seconds(F.get(sides, F.lit(0)))).alias("start"), F.when(ok, timestamp_seconds(F.get(sides, F.lit(1)))).alias("end"))


def clean_llm_json(col: Column) -> Column:
    """A model's answer without code fences or a thinking block around its JSON. A thinking
    block that is not closed gives null."""
    s = strip(col)
    after = F.get(F.split(s, r"\Q</think>\E"), F.lit(1))
    head = (F.when(s.startswith("```json"), F.substring(s, 8, 1 << 30)).when(s.startswith("```"), F.substring(s, 4, 1 << 30))
            .when(s.startswith("<think>"), after).otherwise(s))
    return strip(F.regexp_replace(head, r"```\z", ""))


# UTF-8 read byte by byte as Windows-1252 or Latin-1: a lead byte's character and those of its continuation bytes.
_TAIL = "[\x80-\xbf€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ]"
_MOJIBAKE = re.compile(f"[ÂÃ]{_TAIL}|â{_TAIL}{{2}}|(?:[ÐÑ]{_TAIL}){{2,}}|ð{_TAIL}{{3}}")


def _unread(m: re.Match) -> str:
    raw = b"".join(c.encode("latin-1") if ord(c) < 256 else c.encode("cp1252") for c in m[0])
    try:
        return raw.decode("utf-8")
    except UnicodeDecodeError:
        return m[0]


_CONTROL = dict.fromkeys([*range(0, 9), 11, *range(14, 32), 127, 0xFEFF, *range(0xFFF9, 0xFFFC)])
_CURLY = str.maketrans({"‘": "'", "’": "'", "‚": "'", "‛": "'", "“": '"', "”": '"', "„": '"', "‟": '"', "ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl"})


def repair_text(text: str) -> str:
    """Mojibake of UTF-8 read as Latin-1 or Windows-1252 undone, entities unescaped (where the
    text has no tags), quotes straightened, ligatures split, control characters removed, line
    breaks unified, composed form. A documented subset of full text repair."""
    if "&" in text and "<" not in text:
        text = html.unescape(text)
    text = _MOJIBAKE.sub(_unread, text)
    text = text.replace("\r\n", "\n").replace("\r", "\n").translate(_CONTROL).translate(_CURLY)
    return unicodedata.normalize("NFC", text)
