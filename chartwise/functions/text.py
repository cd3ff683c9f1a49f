"""Text helpers: whitespace stripping, column-name normalising, labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unicode white space removed by a full strip (F.trim removes blanks only).
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) \
    + "\u2028\u2029\u202f\u205f\u3000"

# Fixed value: default chart-label width in characters.
DEFAULT_LABEL_WIDTH = 28


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def normalize_name(name: str) -> str:
    """Column-name rule: strip, lower-case, blanks to underscores."""
    return name.strip().lower().replace(" ", "_")


def ascii_safe(c) -> Column:
    """Every non-ASCII code point becomes one ``?``."""
    return F.regexp_replace(_col(c), r"[^\x00-\x7F]", "?")


def label(c, max_chars: int = DEFAULT_LABEL_WIDTH, ascii_only: bool = True) -> Column:
    """Chart label: the first ``max_chars`` code points, ASCII-safe when the
    renderer has no CJK font. NULL renders as an empty label."""
    s = F.substring(F.coalesce(_col(c).cast("string"), F.lit("")), 1, max_chars)
    return ascii_safe(s) if ascii_only else s
