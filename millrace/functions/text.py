"""Text repair and normalisation expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character that counts as white space at the edge of a text.
WHITE_SPACE = (
    " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
_LETTER_BORDER = r"(?<=\p{L})(?=\P{L})|(?<=\P{L})(?=\p{L})"


def strip(c: Column) -> Column:
    """Remove every kind of leading and trailing white space (plain ``trim`` only knows blanks)."""
    return F.trim(c, F.lit(WHITE_SPACE))


def title(c: Column) -> Column:
    """Upper-case the first letter of each run of letters, lower-case the rest.

    ``initcap`` breaks words at blanks only, so ``semi-remolque`` would keep a
    small ``r``; cutting at each letter border handles hyphens, digits and quotes.
    Texts of letters and blanks only, the common case, need no cutting.
    """
    pieces = F.array_join(F.transform(F.split(c, _LETTER_BORDER), F.initcap), "")
    return F.when(c.rlike(r"[^\p{L} ]"), pieces).otherwise(F.initcap(c))


def strip_title(c: Column) -> Column:
    return title(strip(c))


def has_edge_space(c: Column, nulls: bool = False) -> Column:
    """True where stripping changes the text; ``nulls=True`` also flags missing text."""
    changed = strip(c) != c
    return F.coalesce(changed, F.lit(nulls))


def repair_mojibake(c: Column) -> Column:
    """Undo one round of UTF-8 bytes read as latin-1, only where that is what happened.

    The text must consist of latin-1 characters, hold at least one UTF-8 lead
    byte, and its bytes must form valid UTF-8; anything else is left alone.
    """
    as_bytes = F.encode(c, "ISO-8859-1")
    suspicious = c.rlike(r"^[\x{00}-\x{FF}]*[\x{C2}-\x{F4}][\x{80}-\x{BF}]+[\x{00}-\x{FF}]*$")
    return F.when(suspicious & F.is_valid_utf8(as_bytes.cast("string")), as_bytes.cast("string")).otherwise(c)


def latin1_safe(c: Column) -> Column:
    """Replace each character outside latin-1 by ``?``."""
    return F.regexp_replace(c, r"[^\x{00}-\x{FF}]", "?")


def drop_number_prefix(c: Column) -> Column:
    """``03_Ridge`` -> ``Ridge``: cut up to the first underscore."""
    return F.regexp_replace(c, r"^[^_]*_", "")
