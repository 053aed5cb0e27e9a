"""Text expressions for the word count: split, trim and lower-case.

The trim removes every leading and trailing character up to U+0020 (controls
and space), as ``java.lang.String.trim`` does; Spark's ``trim`` removes only
spaces.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters at or below U+0020 at either end of a token.
_EDGE_CONTROLS = r"^[\x00-\x20]+|[\x00-\x20]+$"
_CONTROLS = "".join(chr(i) for i in range(0x21))

# Characters with a meaning in a regex outside a character class.
_REGEX_SPECIAL = set(".$|()[]{}^?*+\\")

# Characters with a meaning inside a regex character class.
_CLASS_SPECIAL = set("\\]^-[&")


def separator_pattern(separators: str) -> str:
    """Regex matching any one of ``separators``.

    One separator gives a one- or two-character pattern, which Java splits
    without running the regex engine; several give a character class.
    """
    if not separators:
        raise ValueError("at least one separator is required")
    chars = list(dict.fromkeys(separators))
    if len(chars) == 1:
        ch = chars[0]
        return "\\" + ch if ch in _REGEX_SPECIAL else ch
    body = "".join("\\" + ch if ch in _CLASS_SPECIAL else ch for ch in dict.fromkeys(separators))
    return "[" + body + "]"


def text_pieces(c: Column, separators: str, piece_chars: int) -> Column:
    """Array of consecutive pieces of a text, which end before a separator or with
    the text: each has ``piece_chars`` characters and what follows up to the next
    separator. One pass over the text; a short text is one piece, a null text
    gives null."""
    if piece_chars < 1:
        raise ValueError("piece_chars must be at least 1")
    body = "".join("\\" + ch if ch in _CLASS_SPECIAL else ch for ch in dict.fromkeys(separators))
    return F.when(F.length(c) <= piece_chars, F.array(c)).otherwise(
        F.regexp_extract_all(c, F.lit(f"(?s).{{1,{piece_chars}}}[^{body}]*"), F.lit(0))
    )


def java_trim(c: Column) -> Column:
    """Strip characters up to U+0020 from both ends (no regex)."""
    return F.trim(c, F.lit(_CONTROLS))


def normalize_token(c: Column) -> Column:
    """Trim, then lower-case."""
    return F.lower(java_trim(c))


def normalize_word(word: str) -> str:
    """Driver-side twin of :func:`normalize_token` for stop-word lists."""
    return re.sub(_EDGE_CONTROLS, "", word).lower()

