"""One form for texts that look alike.

A quick check inside the JVM (regular expressions over the properties below) finds the texts that can hold an unstable
character; all others never reach Python. In those, only the segments between plain blanks that hold one are
normalised, each with its own neighbourhood as context, and spliced back into the unchanged text.

The properties are taken from the Unicode character database: characters that composition changes (NFC_Quick_Check No),
that can compose with what stands before them or change places with it (Maybe), and compatibility forms that look
like what they stand for. Texts that are canonically equivalent come out equal.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Look-alikes of Latin letters.
CYRILLIC = dict(zip("аеорсухѕіјԁһԛԝүѵӏАВЕКМНОРСТУХЅІЈҮѴӀ", "aeopcyxsijdhqwyvlABEKMHOPCTYXSIJYVI", strict=True))
GREEK = dict(zip("οαρνικυχτγηΑΒΕΖΗΙΚΜΝΟΡΤΥΧ", "oapvikuxtynABEZHIKMNOPTYX", strict=True))
ARMENIAN = dict(zip("օոսհցզՕՏԼ", "onuhgqOSL", strict=True))
CHEROKEE = dict(zip("ᎪᏴᏟᎠᎬᎻᎫᏦᏞᎷᏢᏒᏚᎢᏙᎳᏃ", "ABCDEHJKLMPRSTVWZ", strict=True))
PHONETIC = dict(zip("ɑɡᴄᴏᴠᴡᴢꜱ", "agcovwzs", strict=True))
LATIN = CYRILLIC | GREEK | ARMENIAN | CHEROKEE | PHONETIC
TO_CYRILLIC = {v: k for k, v in reversed(CYRILLIC.items())}
TO_GREEK = {v: k for k, v in reversed(GREEK.items())}

# Character classes, in notation that Java and Python share.
INVISIBLE = r"­͏؜᠎​‎‏‪-‮⁠-⁤⁦-⁯﻿ㅤﾠ"
JOINERS = r"‌‍"
SPACES = r"   -   　"
HYPHENS = r"‐‑﹣"
# Decompositions whose result looks like the character itself; others change what is seen (², ½, ①, …).
SAME_LOOK = ("<wide>", "<narrow>", "<font>", "<noBreak>", "<small>", "<initial>", "<medial>", "<final>", "<isolated>")


LAST = 0x32000  # no character beyond it has a decomposition


def _same_look(c: str) -> bool:
    """Compatibility forms to replace: by kind, and ligatures, digraphs, numerals and signs written as letters. Latin
    letters up to U+017F stay as they are."""
    kind, _, _ = unicodedata.decomposition(c).partition(" ")
    if not kind.startswith("<") or "\u00bf" < c <= "\u017f":
        return False
    written = unicodedata.normalize("NFKC", c)
    return (kind in SAME_LOOK or (kind == "<compat>" and written.isalpha())) and not any(x.isspace() for x in written)


def _class_of(chars: Iterable[str]) -> str:
    """Characters as ranges, which Java and Python read alike; none of them is a sign of the notation."""
    codes = sorted({*map(ord, chars)})
    starts = [n for i, n in enumerate(codes) if i == 0 or codes[i - 1] != n - 1]
    ends = [n for i, n in enumerate(codes) if i + 1 == len(codes) or codes[i + 1] != n + 1]
    return "".join(chr(a) if a == b else f"{chr(a)}-{chr(b)}" for a, b in zip(starts, ends, strict=True))


def _properties() -> tuple[str, str, str]:
    """(changed, moving, forms): characters that composition changes; those that compose with what stands before them or
    change places with it; compatibility forms that look like what they stand for."""
    changed, forms = set(), set()
    # Hangul's vowels and finals compose by rule.
    moving = {chr(n) for n in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for n in (*range(0x80, 0xD800), *range(0xE000, LAST)):
        c = chr(n)
        parts = unicodedata.decomposition(c).split()
        if unicodedata.combining(c):
            moving.add(c)
        if not unicodedata.is_normalized("NFC", c):
            changed.add(c)
        elif len(parts) == 2 and parts[0][0] != "<":
            moving.add(chr(int(parts[1], 16)))
        if parts and any(map(_same_look, unicodedata.normalize("NFD", c))):
            forms.add(c)
    return _class_of(changed), _class_of(moving), _class_of(forms)


CHANGED, MOVING, FORMS = _properties()
UNSTABLE = CHANGED + MOVING + FORMS + INVISIBLE + JOINERS + SPACES + HYPHENS
ALIKE = "".join(PHONETIC)
OTHER_SCRIPTS = r"\p{IsCyrillic}\p{IsGreek}\p{IsArmenian}\p{IsCherokee}"

#: Texts of nothing but these can't be unstable: Latin letters, common signs, pictures.
BEYOND = r"[^\x00-\x7F«»°À-ſ‘-”–—…€☀-➿️" + "\U0001f300-\U0001faff]"

#: In Java's dialect; looked for at characters of BEYOND alone. Of the marks all pass, as their class is shorter than its
#: stable and unstable parts.
QUICK_CHECK = rf"(?={BEYOND})(?:[{CHANGED}{FORMS}{INVISIBLE}{JOINERS}{SPACES}{HYPHENS}{ALIKE}\u1161-\u1175\u11a8-\u11c2]|(?!\ufe0f)\p{{M}}|(?<=\p{{IsLatin}})[{OTHER_SCRIPTS}]|[{OTHER_SCRIPTS}](?=\p{{IsLatin}}))"

_SEGMENT = re.compile(r"[^ \t\r\n]+")
_MAYBE = re.compile(f"[{UNSTABLE}{ALIKE}Ͱ-ϿЀ-ԯԱ-֏Ꭰ-\u13ffἀ-῿]")
_JOINER = re.compile(f"[{JOINERS}]")
_DROPPED = re.compile(f"[{INVISIBLE}]")
_FORMS = re.compile(f"[{FORMS}]+")
_SPACE = re.compile(f"[{SPACES}]")
_HYPHEN = re.compile(f"[{HYPHENS}]")
_WORD = re.compile(r"[^\W\d_](?:[^\W\d_]|[\u0300-\u036F])*")
# Scripts that write with joiners, by the start of their characters' names.
_JOINING = ("ARABIC", "SYRIAC", "DEVANAGARI", "BENGALI", "GURMUKHI", "GUJARATI", "ORIYA", "TAMIL", "TELUGU", "KANNADA", "MALAYALAM", "SINHALA", "MONGOLIAN", "KHMER", "MYANMAR", "TIBETAN")


def _script(c: str) -> str:
    n = ord(c)
    if 0x370 <= n <= 0x3FF or 0x1F00 <= n <= 0x1FFF:
        return "G"
    return "C" if 0x400 <= n <= 0x52F else "L" if n < 0x250 or 0x1E00 <= n <= 0x1EFF or c in PHONETIC else "O"


def _emoji(c: str) -> bool:
    return bool(c) and (c == "️" or unicodedata.category(c) in ("So", "Sk") or 0x1F000 <= ord(c) <= 0x1FAFF)


def _joiner_stays(text: str, i: int) -> bool:
    before, after = text[i - 1 : i] if i else "", text[i + 1 : i + 2]
    if not before or not after:
        return False
    if _emoji(before) and _emoji(after):
        return True
    return all(unicodedata.name(c, "").startswith(_JOINING) for c in (before, after))


def _one_script(m: re.Match) -> str:
    if m[0].isascii():
        return m[0]
    word = unicodedata.normalize("NFD", m[0])  # so that an accent hides no letter; composed again in the end
    scripts = {_script(c) for c in word if not unicodedata.combining(c)}
    if scripts == {"L"}:
        # A phonetic letter among plain ones.
        return "".join(PHONETIC.get(c, c) for c in word) if any(c in PHONETIC for c in word) and any(c.isascii() for c in word) else word
    if "L" not in scripts and not {"C", "G"} <= scripts:
        return word
    if all(_script(c) == "L" or c in LATIN or unicodedata.combining(c) for c in word) and "L" in scripts:
        return "".join(LATIN.get(c, c) for c in word)
    for script, table in (("C", TO_CYRILLIC), ("G", TO_GREEK)):
        own = sum(_script(c) == script for c in word)
        if own > sum(_script(c) == "L" for c in word) and all(_script(c) == script or c in table or unicodedata.combining(c) for c in word):
            return "".join(c if _script(c) == script else table.get(c, c) for c in word)
    return word


def canonical_segment(s: str) -> str:
    """The canonical form of one segment without plain blanks, composed at the end, so that equivalent texts meet."""
    if _JOINER.search(s):
        s = "".join(c for i, c in enumerate(s) if c not in "‌‍" or _joiner_stays(s, i))
    s = _DROPPED.sub("", s)
    s = _SPACE.sub(" ", s)
    s = _HYPHEN.sub("-", s)
    s = _FORMS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), s)
    s = _WORD.sub(_one_script, s)  # before composing, as an accent may follow a look-alike letter
    return s if unicodedata.is_normalized("NFC", s) else unicodedata.normalize("NFC", s)


def canonical(text: str | None) -> str | None:
    """The whole text with its unstable segments replaced."""
    if text is None or not _MAYBE.search(text):
        return text
    return _SEGMENT.sub(lambda m: canonical_segment(m[0]) if _MAYBE.search(m[0]) else m[0], text)


def _udf() -> Callable:
    @F.pandas_udf("string")
    def run(texts: pd.Series) -> pd.Series:
        return texts.map(canonical, na_action="ignore")

    return run


def unstable(text: Column) -> Column:
    """The quick check, after a quicker one: texts of nothing but Latin letters and common signs are stable."""
    return text.rlike(BEYOND) & text.rlike(QUICK_CHECK)


def canonical_form(text: Column) -> Column:
    """The text in canonical form: full-width forms, ligatures of f, separate accents, invisible characters, blanks and
    hyphens other than the plain ones, and look-alike letters inside words of another script are replaced.

    Left alone: words wholly in one script, emoji of several code points, typographic quotes, dashes and ellipses, tabs
    and line breaks. Null gives null; an empty text stays empty. Texts that pass the quick check are handed to Python
    as null.
    """
    return F.coalesce(_udf()(F.when(unstable(text), text)), text)


def has_variants(text: Column) -> Column:
    """True where the canonical form differs from the text; null is False. The quick check comes first."""
    return F.coalesce(_udf()(F.when(unstable(text), text)) != text, F.lit(False))
