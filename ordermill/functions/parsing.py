"""Dirty text to typed values. Every helper is ``Column -> Column`` and ignores session settings.

``try_cast`` is used throughout, so text that does not parse is null under ANSI mode as well.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F


# What \s matches in a Java pattern.
WHITE_SPACE = " \t\n\x0b\f\r"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def blank_to_null(text: Column | str) -> Column:
    """Text made of spaces only becomes null."""
    text = _column(text)
    return F.when(F.length(F.trim(text)) > 0, text)


def number_text(text: Column | str) -> Column:
    """Without white space, and with every comma read as a decimal point."""
    return F.translate(_column(text), "," + WHITE_SPACE, ".")


def parse_number(text: Column | str, dtype: str) -> Column:
    """Dirty number text as ``dtype``; ``int`` goes through double and rounds half up. Blank text
    is null, as there is nothing left of it to cast."""
    clean = number_text(text)
    if dtype in ("int", "bigint"):
        return F.round(clean.try_cast("double")).try_cast(dtype)
    return clean.try_cast(dtype)


def parse_date(text: Column | str, forms: Sequence[str] = ("-", "/"), strict: bool = False) -> Column:
    """Year-month-day text in any of ``forms`` as a date; one-digit months and days are accepted.

    ``forms`` holds separators, and optionally ``"dd/MM/yyyy"``, tried last. Text after the date
    is ignored unless ``strict``; a further digit directly after the day never is.
    """
    text = F.trim(_column(text))
    end = "$" if strict else r"(\D|$)"
    separators = "".join("\\" + form for form in forms if len(form) == 1)
    candidates = []
    if separators:
        core = F.regexp_extract(text, rf"^(\d{{1,4}}([{separators}])\d{{1,2}}\2\d{{1,2}}){end}", 1)
        # The zeros make short years four digits long; on no match "000" is not a date.
        plain = core
        for form in forms:
            if len(form) == 1 and form != "-":
                plain = F.translate(plain, form, "-")
        candidates.append(F.concat(F.lit("000"), plain).try_cast("date"))
    for form in forms:
        if len(form) == 1:
            continue
        if form != "dd/MM/yyyy":
            raise ValueError(f"unknown date form: {form}")
        pattern = rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}){end}"
        day, month, year = (F.regexp_extract(text, pattern, group) for group in (1, 2, 3))
        candidates.append(F.concat_ws("-", year, month, day).try_cast("date"))
    if not candidates:
        raise ValueError("at least one date form is needed")
    return F.coalesce(*candidates)
