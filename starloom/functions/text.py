"""Text cleanup expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with a stroke or without a dot, which Unicode does not take apart.
ACCENTED, PLAIN = "ØøÐðĐđĦħıŁłŦŧ", "OoDdDdHhiLlTt"
# Letters that fold to two.
LIGATURES = {"Æ": "AE", "æ": "ae", "Œ": "OE", "œ": "oe", "ß": "ss", "Þ": "Th", "þ": "th"}


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_name(c) -> Column:
    """``initcap(trim(x))``: the canonical spelling of a name.  ``initcap``
    splits words at spaces only (``dos-santos`` → ``Dos-santos``)."""
    return F.initcap(F.trim(_c(c)))


def py_strip(c) -> Column:
    """Strip all leading/trailing whitespace (tabs and newlines too), like
    Python's ``str.strip``; ``F.trim`` removes blanks only."""
    return F.regexp_replace(_c(c), r"^\s+|\s+$", "")


@cache
def _letters() -> tuple[str, str]:
    """Letters that Unicode takes apart into a letter and marks, of all scripts
    below U+2000 (Latin, Greek, Cyrillic, Vietnamese …), and those letters."""
    apart = {chr(c): unicodedata.normalize("NFD", chr(c)) for c in range(0xC0, 0x2000)}
    found = {c: d[0] for c, d in apart.items() if len(d) > 1 and all(unicodedata.category(m) == "Mn" for m in d[1:])}
    return "".join(found), "".join(found.values())


def fold_accents(c) -> Column:
    """Replace letters with diacritics by their base letter, in any script with
    letters below U+2000 and also where the marks are characters of their own;
    ligatures by two letters."""
    letters, bases = _letters()
    out = F.regexp_replace(F.translate(_c(c), letters + ACCENTED, bases + PLAIN), r"\p{Mn}+", "")
    for letter, two in LIGATURES.items():
        out = F.replace(out, F.lit(letter), F.lit(two))
    return out


#: Case and accents do not count.
NAMES = "UNICODE_CI_AI"


def collated(c, collation: str = NAMES) -> Column:
    """A name under an ICU collation: joins, groups and distinct then compare
    by it, while the spelling stays."""
    return F.collate(_c(c), collation)


def plain(c) -> Column:
    """Back to comparison by bytes."""
    return F.collate(_c(c), "UTF8_BINARY")


# Fixed value: text that can hold an integer (optional sign, digits, blanks around).
INT_TEXT = r"^\s*[+-]?\d+\s*$"


def try_int(c, type_name: str = "int") -> Column:
    """Tolerant text → integer: null when the text is not a number or does
    not fit.  The pattern test runs first so non-numeric text never reaches
    the cast's error path (which is slow when most rows are dirty)."""
    col = _c(c)
    return F.when(col.rlike(INT_TEXT), col.try_cast(type_name))
