"""Text cleaning, recoding and identifiers."""

from __future__ import annotations

import unicodedata
from collections.abc import Mapping, Sequence
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import col

def _latin_pairs() -> tuple[str, str]:
    """Every accented Latin letter whose canonical base is one ASCII letter, and those bases."""
    accented, plain = [], []
    for code in range(0xC0, 0x250):
        base = "".join(m for m in unicodedata.normalize("NFD", chr(code)) if unicodedata.category(m) != "Mn")
        if len(base) == 1 and base.isascii() and base != chr(code):
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


ACCENTED, PLAIN = _latin_pairs()


def strip_accents(c) -> Column:
    """Replace accented letters by plain ones and drop combining marks."""
    return F.regexp_replace(F.translate(col(c), ACCENTED, PLAIN), r"\p{Mn}", "")


def clean_text(c) -> Column:
    """Unaccented lower-case words of a-z only, single-spaced. Punctuation inside a word vanishes."""
    no_marks = F.regexp_replace(strip_accents(c), r"[^\p{L}\p{N}_\s]", "")
    return F.lower(F.trim(F.regexp_replace(no_marks, r"[^a-zA-Z]+", " ")))


def clean_name(c) -> Column:
    """Unaccented, lower-case, trimmed name for lookups (digits and marks kept)."""
    return F.lower(F.trim(strip_accents(c)))


def strip_chars(c, chars: str) -> Column:
    """Drop every listed character and trim."""
    return F.trim(F.translate(col(c).cast("string"), chars, ""))


def pct_to_fraction(c) -> Column:
    """``'12.5%'`` or 12.5 to 0.125."""
    return strip_chars(c, "%").try_cast("double") / 100


def digits_or_null(c) -> Column:
    """Value when it holds digits only, else null."""
    v = col(c).cast("string")
    return F.when(v.rlike(r"\D"), None).otherwise(v)


def composite_id(cols: Sequence, sep: str = "-") -> Column:
    """Join key parts with ``sep``; a null part is skipped."""
    return F.concat_ws(sep, *[col(c).cast("string") for c in cols])


def recode_values(c, mapping: Mapping, keep_other: bool = True) -> Column:
    """Fixed relabelling through a map literal. Unlisted values stay, or become null."""
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])
    found = F.try_element_at(lookup, col(c))
    return F.coalesce(found, col(c)) if keep_other else found


def first_match_code(c, patterns: Sequence[tuple[str, str]]) -> Column:
    """First pattern contained in the text decides the code; no match is null."""
    out = F.lit(None).cast("string")
    for needle, code in reversed(patterns):
        out = F.when(col(c).contains(needle), F.lit(code)).otherwise(out)
    return out


# Order decides, the first letter found wins.
SEX_CODES = [("H", "H"), ("M", "M")]
ORIGIN_CODES = [("F", "F"), ("E", "E"), ("M", "M")]


def short_hash(c, n: int = 32) -> Column:
    """First ``n`` hex characters of the SHA-1."""
    return F.substring(F.sha1(col(c).cast("string")), 1, n)


def shorten_identifier(c, limit: int = 55, n: int = 32) -> Column:
    """Long names lose their vowels; still too long ones become 5 characters plus a hash of ``n - 5``."""
    v = col(c).cast("string")
    no_vowels = F.regexp_replace(v, "(?i)[aeiou]", "")
    hashed = F.concat(F.substring(v, 1, 5), short_hash(v, n - 5))
    return F.when(F.length(v) <= limit, v).when(F.length(no_vowels) <= limit, no_vowels).otherwise(hashed)


def split_variable(c) -> Column:
    """struct<variable, tipo> of a suffixed indicator name."""
    v = col(c)
    name = (
        F.when(v.contains("_porcentaje"), F.regexp_replace(v, "_porcentaje", ""))
        .when(v.contains("_num"), F.regexp_replace(v, "_num", ""))
        .otherwise(v)
    )
    kind = (
        F.when(v.contains("_porcentaje") | v.contains("int_"), "porcentaje")
        .when(v.contains("_num") | v.contains("_carencias"), "nominal")
        .otherwise("")
    )
    return F.struct(name.alias("variable"), kind.alias("tipo"))


def pad_left(text: Column | str, length: int, fill: str = "0") -> Column:
    """Left-pad to ``length``; longer text stays whole, so two codes never become the same key."""
    c = F.col(text) if isinstance(text, str) else text
    return F.when(F.length(c) >= length, c).otherwise(F.lpad(c, length, fill))
