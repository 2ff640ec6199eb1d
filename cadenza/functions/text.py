"""Text functions as Columns.

Accents of Latin letters are taken off by a literal table inside the JVM; only texts with other characters that
normalisation can change are handed to Python, in Arrow batches.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# Words without weight in a title.
STOPWORDS = ("de", "du", "des", "la", "le", "les", "l", "d", "a", "au", "aux", "et", "en", "un", "une", "the", "of", "avec", "par", "sur")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with ``value`` evaluated once, however often it is named: the expression stays as small as it is written.
    An aggregate over nothing hands its start value to its last step; an array's element would do the same, but works its
    type out again for every row."""
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def _latin_table() -> tuple[str, str]:
    pairs = []
    for n in (*range(0xC0, 0x180), *range(0x1E00, 0x1F00)):
        base = "".join(c for c in unicodedata.normalize("NFD", chr(n)) if unicodedata.category(c) != "Mn")
        if len(base) == 1 and base != chr(n):
            pairs.append((chr(n), base))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


_ACCENTED, _BASE = _latin_table()
# Characters that no normalisation form changes beyond the Latin table: Latin itself, and common punctuation.
_PLAIN = r"^[\x00-\x7F«»¡¿§©®°±×÷À-ſḀ-ỿ‐‒-‛“-„†•›‹€]*$"
# As above, for the compatibility forms: composed Latin letters stay as they are.
_STABLE = r"^[\x00-\x7F«»¡¿§©®°±×÷À-ıĴ-ľŁ-ňŊ-žḀ-ẙ‐‒-–—‘-‛“-„†•›‹€]*$"


def _mapped(f: Callable[[str], str]) -> Callable:
    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action="ignore")

    return run


def _without_marks(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if unicodedata.category(c) != "Mn")


def folded_text(s: str) -> str:
    """A text as ``dates.fold`` leaves it, outside Spark."""
    return " ".join(_without_marks(s).split()).lower()


def _compatible(s: str) -> str:
    return unicodedata.normalize("NFKC", s)


def strip_accents(text: Column) -> Column:
    """FN-2: the text decomposed, without its non-spacing marks. Null stays null."""
    return F.coalesce(_mapped(_without_marks)(F.when(~text.rlike(_PLAIN), text)), F.translate(text, _ACCENTED, _BASE))


def strip_latin_accents(text: Column) -> Column:
    """``strip_accents`` for texts known to be Latin: inside the JVM throughout."""
    return F.translate(text, _ACCENTED, _BASE)


def normalize_text(text: Column) -> Column:
    """FN-1: compatibility form, straight quotes, single blanks, trimmed, lower case."""
    composed = F.coalesce(_mapped(_compatible)(F.when(~text.rlike(_STABLE), text)), text)
    straight = F.translate(composed, "‘’“”", "''\"\"")
    return F.lower(F.btrim(F.regexp_replace(straight, r"(?U)\s+", " ")))


def title_key(text: Column) -> Column:
    """Normalised and without accents: the key by which titles are compared."""
    return strip_accents(normalize_text(text))


def slugify(text: Column, default: str = "venue") -> Column:
    """FN-3: runs of anything but letters a-z and digits become one hyphen; ``default`` where nothing is left."""
    plain = F.lower(strip_accents(F.coalesce(_mapped(_compatible)(F.when(~text.rlike(_STABLE), text)), text)))
    slug = F.regexp_replace(F.regexp_replace(plain, r"[^a-z0-9]+", "-"), r"^-+|-+$", "")
    return F.when(text.isNotNull(), F.when(slug == "", F.lit(default)).otherwise(slug))


def event_uid(venue: Column, title: Column, start: Column) -> Column:
    """FN-4: the first 12 hex digits of the SHA-1 of venue, title key and ISO day, joined by vertical bars."""
    return F.substring(F.sha1(F.concat_ws("|", venue, title_key(title), start.cast("string"))), 1, 12)


def content_hash(text: Column) -> Column:
    """DOC-2."""
    return F.substring(F.sha2(text, 256), 1, 16)


def strip_ellipsis(title: Column) -> Column:
    """FN-5: struct(title, truncated) with a trailing ellipsis taken off."""
    bare = F.regexp_replace(title, r"(?U)\s*(?:\.{3}|…)\s*$", "")
    return F.struct(bare.alias("title"), (bare != title).alias("truncated"))


def extract(value: Column, pattern: str | None) -> Column:
    """FN-6: the first match's first group, or the whole match of a pattern without groups; '' without a match. The
    pattern is applied over lines and without regard to case."""
    if not pattern:
        return value
    group = 1 if re.compile(pattern).groups else 0
    return F.trim(F.regexp_extract(value, f"(?isu){pattern}", group))


def strip_markup(text: Column) -> Column:
    """FN-7: tags become blanks, the commonest entities their characters, white space single blanks."""
    bare = F.regexp_replace(text, r"<[^>]+>", " ")
    for entity, c in (("&#038;", "&"), ("&amp;", "&"), ("&nbsp;", " "), ("&#8217;", "'")):
        bare = F.replace(bare, F.lit(entity), F.lit(c))
    return F.btrim(F.regexp_replace(bare, r"(?U)\s+", " "))


def clip(text: Column, n: int) -> Column:
    """FN-8: single blanks, and at most n characters with three dots in place of the rest."""
    flat = F.btrim(F.regexp_replace(text, r"(?U)\s+", " "))
    return F.when(F.length(flat) <= n, flat).otherwise(F.concat(F.rtrim(F.substring(flat, 1, n - 3)), F.lit("...")))


def title_tokens(title: Column) -> Column:
    """FN-14: distinct words of two letters or more (a-z, 0-9), without stopwords, in order."""
    words = F.regexp_extract_all(title_key(title), F.lit(r"([a-z0-9]+)"), F.lit(1))
    return F.array_except(F.array_distinct(F.filter(words, lambda w: F.length(w) > 1)), F.array(*[F.lit(w) for w in STOPWORDS]))


def overlap(a: Column, b: Column) -> Column:
    """FN-15: shared tokens over the smaller set's size; 0 where a set is empty."""
    return F.when((F.size(a) > 0) & (F.size(b) > 0), F.size(F.array_intersect(a, b)) / F.least(F.size(a), F.size(b))).otherwise(F.lit(0.0))


def extends_prefix(longer: Column, prefix: Column) -> Column:
    """FN-16: by title key, ``longer`` begins with ``prefix`` and goes on."""
    return let(F.struct(title_key(longer).alias("a"), title_key(prefix).alias("b")), lambda s: s["a"].startswith(s["b"]) & (F.length(s["a"]) > F.length(s["b"])))


#: A digit before the letter h or a colon.
A_TIME = r"\d\s*[h:]"


def looks_like_time(text: Column) -> Column:
    """FN-17."""
    return text.rlike(A_TIME)


def absolute_url(base: Column, url: Column) -> Column:
    """FN-13: ``url`` resolved against ``base``. Absolute addresses stay inside the JVM."""

    @F.pandas_udf("string")
    def joined(bases: pd.Series, urls: pd.Series) -> pd.Series:
        return pd.Series([None if u is None else _join(b, u) for b, u in zip(bases, urls, strict=True)])

    return F.when(url.rlike(r"^https?://[^/]+"), url).otherwise(joined(base, url))


def _join(base: str | None, url: str) -> str:
    try:
        return urljoin(base or "", url)
    except ValueError:
        return url


def host(url: Column) -> Column:
    return F.lower(F.try_parse_url(url, F.lit("HOST")))


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 1 where both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / union)
