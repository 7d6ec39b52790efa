"""Text cleaning: whitespace, title case, accents, slugs, e-mail repair."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values -------------------------------------------------------------
# White space is what Python's str methods see as such: Java's \s is narrower.
WHITESPACE = "".join(chr(c) for c in range(0x10000) if chr(c).isspace())
WHITESPACE_CLASS = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"
NULL_WORDS = ("N/A", "NAN", "NONE", "NULL")
NO_CATEGORY = "Sin categoría"
NO_DESCRIPTION = "Sin descripción"
DEFAULT_SLUG = "usuario.desconocido"
FALLBACK_DOMAIN = "@sin-correo.local"
ACCEPTED_EMAIL = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"
STORED_EMAIL = r"(?i)^[A-Z0-9._%+-]+@[A-Z0-9.-]+\.[A-Z]{2,}\z"
EMPTY_BLOCK = "__empty__"
# --------------------------------------------------------------------------

# Characters with a case, and the seam before a letter that starts a new word.
_CASED = r"a-zA-Z\p{IsUppercase}\p{IsLowercase}\p{Lt}"
_SEAM = "\x01\x02 "
# The look-ahead settles ordinary characters with one range test.
_SPACES = r"(?![!-~])" + WHITESPACE_CLASS + "+"
# Runs that are not one space already; only ordinary characters are looked for behind one.
_UNEVEN_SPACES = r"(?! [!-~])" + _SPACES
# Anything but a blank or a null word.
_FILLED = r"(?s)^(?!(?i:" + "|".join(NULL_WORDS) + r")\z).+\z"


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Every non-ASCII character whose canonical decomposition keeps ASCII.

    Returned as the two arguments of ``translate``; each such character keeps
    exactly one ASCII character.
    """
    source, target = [], []
    for code in range(0x80, 0x10000):
        kept = [c for c in unicodedata.normalize("NFD", chr(code)) if ord(c) < 0x80]
        if kept:
            source.append(chr(code))
            target.append(kept[0])
    return "".join(source), "".join(target)


def strip(c: Column) -> Column:
    """Remove leading and trailing white space of any kind."""
    return F.trim(c, F.lit(WHITESPACE))


def collapse_spaces(c: Column) -> Column:
    """Turn each run of white space into one space and trim the ends."""
    return F.trim(F.regexp_replace(c, _UNEVEN_SPACES, " "))


def title_case(c: Column) -> Column:
    """Capital after every character that is not a cased letter.

    ``initcap`` only starts words after spaces, so a seam that ends in a space is
    put before every other word start and taken out again.
    """
    seamed = F.regexp_replace(c, f"([^{_CASED} ])(?=[{_CASED}])", f"$1{_SEAM}")
    return F.regexp_replace(F.initcap(seamed), _SEAM, "")


def first_match(c: Column, pattern: str, group: int = 0) -> Column:
    """Text of the first match, or null.

    Unlike ``when(c.rlike(p), c)`` this mentions ``c`` once: chained cleaners would
    otherwise repeat their input expression many times over.
    """
    return F.try_element_at(F.regexp_extract_all(c, F.lit(pattern), F.lit(group)), F.lit(1))


def if_empty(c: Column, default: str) -> Column:
    return F.regexp_replace(c, r"^\z", default)


def clean_text(c: Column, default: str | None = None, title: bool = False) -> Column:
    """Collapse white space; blanks and null words become ``default``."""
    value = first_match(collapse_spaces(c), _FILLED)
    kept = title_case(value) if title else value
    return kept if default is None else F.coalesce(kept, F.lit(default))


def split_category(c: Column) -> tuple[Column, Column]:
    """``category|description`` at the first pipe, both stripped."""
    named = if_empty(F.coalesce(c, F.lit("")), NO_CATEGORY)
    rest = first_match(c, r"(?s)^[^|]*\|(.*)\z", 1)
    return (
        strip(F.substring_index(named, "|", 1)),
        F.coalesce(strip(rest), F.lit(NO_DESCRIPTION)),
    )


def to_ascii(c: Column) -> Column:
    """Drop accents, then every character that is still not ASCII."""
    return F.regexp_replace(F.translate(c, *accent_table()), r"[^\x00-\x7f]+", "")


def fold(c: Column) -> Column:
    """Comparison form: no accents, lower case, single spaces; null -> ''."""
    return F.coalesce(collapse_spaces(F.lower(to_ascii(c))), F.lit(""))


def block_key(title: Column) -> Column:
    """First word of the folded title."""
    return if_empty(F.substring_index(fold(title), " ", 1), EMPTY_BLOCK)


def slug(c: Column) -> Column:
    """Dotted ASCII key for a name."""
    dotted = F.regexp_replace(F.lower(to_ascii(c)), "[^a-z0-9]+", ".")
    return if_empty(F.trim(dotted, F.lit(".")), DEFAULT_SLUG)


def normalize_email(raw: Column, user_name: Column) -> Column:
    """Repair ``_at_`` noise; an address that stays invalid is made from the name."""
    at_signs = F.regexp_replace(F.lower(clean_text(raw)), "_at_", "@")
    at_signs = F.regexp_replace(at_signs, " at ", "@")
    email = F.regexp_replace(at_signs, _SPACES, "")
    fallback = F.concat(slug(user_name), F.lit(FALLBACK_DOMAIN))
    return F.coalesce(first_match(email, ACCEPTED_EMAIL), fallback)


def storable_email(c: Column) -> Column:
    """Format check of the users table (stricter than the cleaner's)."""
    return c.rlike(STORED_EMAIL)


@lru_cache(maxsize=1)
def _casefold_table() -> tuple[str, str]:
    """Letters that fold to another single letter than their lower case."""
    pairs = [
        (low, low.casefold())
        for low in (chr(code) for code in range(0x80, 0x10000))
        if low == low.lower() and low != low.casefold() and len(low.casefold()) == 1
    ]
    return "".join(p[0] for p in pairs), "".join(p[1] for p in pairs)


def caseless(c: Column) -> Column:
    """Key for comparing names without regard to case."""
    folded = F.translate(F.lower(c), *_casefold_table())
    return F.replace(folded, F.lit("ß"), F.lit("ss"))
