"""Expressions on text cut out of log lines, as SQL text for ``selectExpr`` and ``expr``.

The parser is written as SQL text throughout: it makes one call into the JVM per projection where
Column objects would make one or more per function.
"""

from __future__ import annotations

# Fixed value: the characters that count as blank at the ends of a line, request or number list.
BLANKS = "".join(chr(code) for code in range(0x21))


def strip_blanks(text: str) -> str:
    """Drop every character up to and including U+0020 from both ends.

    Spark's ``trim`` drops spaces only. The test on the end characters keeps the character-set
    trim, which is slow, away from the many texts that need none.
    """
    return f"CASE WHEN left({text}, 1) <= ' ' OR right({text}, 1) <= ' ' THEN btrim({text}, '{BLANKS}') ELSE {text} END"


def is_blank(text: str) -> str:
    return f"btrim({text}, '{BLANKS}') = ''"


def whole_number(text: str, kind: str = "INT") -> str:
    """``text`` as an integer, or null unless it is only digits with an optional sign and in range.

    The pattern is needed: a cast alone would accept blanks around the digits.
    """
    return rf"CASE WHEN {text} RLIKE r'^[+-]?[0-9]+\z' THEN try_cast({text} AS {kind}) END"


def words(text: str) -> str:
    """Split stripped text at runs of white space; an empty text is one empty word.

    Spark compiles a splitting pattern anew for each row, so texts with single spaces only, which
    is nearly all of them, are split at the plain character.
    """
    irregular = " OR ".join(f"contains({text}, '{blank}')" for blank in ("  ", "\t", "\n", "\x0b", "\f", "\r"))
    return rf"CASE WHEN {irregular} THEN split({text}, r'\s+') ELSE split({text}, ' ') END"


def empty_to_null(text: str) -> str:
    return f"nullif({text}, '')"


def shorten(text: str, limit: int = 44, keep: int = 41) -> str:
    """Texts longer than ``limit`` become their first ``keep`` characters and three dots."""
    return f"CASE WHEN length({text}) > {limit} THEN left({text}, {keep}) || '...' ELSE {text} END"
