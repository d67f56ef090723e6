"""Product codes and text tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfsight.functions.metrics import to_number

UPC_LENGTH = 12
UNKNOWN_UPC = "0" * UPC_LENGTH


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _zero_fill(text: Column) -> Column:
    # lpad cuts longer strings, so only short ones may reach it
    return F.when(F.length(text) < UPC_LENGTH, F.lpad(text, UPC_LENGTH, "0")).otherwise(text)


def upc_norm12(code: Column | str) -> Column:
    """Digits of ``code`` as a 12 digit UPC; missing and junk codes become all zeros."""
    digits = F.regexp_replace(F.coalesce(_col(code), F.lit("")), "[^0-9]", "")
    is_padded_13 = (F.length(digits) == 13) & digits.startswith("0")
    return F.when(is_padded_13, F.substring(digits, 2, UPC_LENGTH)).otherwise(_zero_fill(digits))


def upc_from_number(text: Column | str) -> Column:
    """UPC of a code that a spreadsheet has turned into a number; NULL if it is not one."""
    return _zero_fill(to_number(_col(text)).try_cast("bigint").cast("string"))


def upc_from_sheet_text(text: Column | str, anywhere: bool = False) -> Column:
    """UPC of a code kept as text but with a ``.0`` tail.

    ``anywhere=True`` deletes every ``.0`` in the text, not just the tail, which
    turns ``1.05`` into ``15``; the default keeps such codes intact.
    """
    text = _col(text)
    bare = F.replace(text, F.lit(".0"), F.lit("")) if anywhere else F.regexp_replace(text, r"\.0$", "")
    return _zero_fill(bare)


def clean_token(text: Column | str) -> Column:
    """Trimmed text; blank and the literal ``nan`` count as missing."""
    trimmed = F.trim(_col(text))
    return F.when(~trimmed.isin("", "nan"), trimmed)
