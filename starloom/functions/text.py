"""Text expressions for names and codes."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(text: Column) -> Column:
    """Remove white space of any kind from both ends."""
    return F.regexp_replace(text, r"^\s+|\s+$", "")


def replace_chain(text: Column, pairs: Iterable[tuple[str, str]], regex: bool = False) -> Column:
    """Apply replacements one after the other, as plain text or as regular expressions."""
    for old, new in pairs:
        text = F.regexp_replace(text, old, new) if regex else F.replace(text, F.lit(old), F.lit(new))
    return text


def first_token(text: Column) -> Column:
    """Text before the first space and the first hyphen, commas turned to spaces, trimmed."""
    head = F.substring_index(F.substring_index(text, " ", 1), "-", 1)
    return F.trim(F.translate(head, ",", " "))


def has_any(text: Column, parts: Iterable[str]) -> Column:
    """True where the text contains one of the parts (case matters)."""
    found = F.lit(False)
    for part in parts:
        found = found | text.contains(part)
    return found


def code_from_text(text: Column, pattern: str, drop: str = "- ") -> Column:
    """First group of ``pattern`` without the characters in ``drop``; NULL if nothing matches."""
    return F.translate(F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")), drop, "")


def _plain_letters() -> tuple[str, str]:
    accented, plain = [], []
    for point in range(0xC0, 0x180):
        base = unicodedata.normalize("NFD", chr(point))[0]
        if base != chr(point):
            accented.append(chr(point))
            plain.append(base)
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _plain_letters()


def fold(text: Column) -> Column:
    """Form used to compare names: trimmed, lower case, Latin letters without accents."""
    return F.translate(F.lower(strip(text)), _ACCENTED, _PLAIN)
