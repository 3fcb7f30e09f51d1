"""Text expressions: chunking, tokenising, list-literal parsing.

Lengths and slices count Unicode code points, as Spark's ``length`` and
``substring`` do.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def chunk_chars(col: Column | str, size: int = 512) -> Column:
    """Array of consecutive ``size``-character slices; the last one is short.

    Empty text gives an empty array (so ``explode`` drops the row), NULL gives
    NULL. ``filter`` removes the bogus index that ``sequence(0, -1)`` would
    produce for empty text.
    """
    text = _c(col)
    n = F.greatest(F.ceil(F.length(text) / F.lit(size)).cast("int") - 1, F.lit(0))
    idx = F.filter(F.sequence(F.lit(0), n), lambda i: F.length(text) > i * size)
    return F.when(text.isNotNull(),
                  F.transform(idx, lambda i: text.substr(i * size + 1, F.lit(size))))


def word_tokens(col: Column | str, pattern: str = r"\s+") -> Column:
    """Array of non-empty tokens split on ``pattern`` (whitespace by default)."""
    return F.filter(F.split(_c(col), pattern), lambda x: x != "")


def chunk_tokens(col: Column | str, size: int = 500) -> Column:
    """Array of chunks of ``size`` whitespace tokens, re-joined by one space."""
    toks = word_tokens(col)
    n = F.greatest(F.ceil(F.size(toks) / F.lit(size)).cast("int") - 1, F.lit(0))
    idx = F.filter(F.sequence(F.lit(0), n), lambda i: F.size(toks) > i * size)
    return F.when(_c(col).isNotNull(), F.transform(
        idx, lambda i: F.array_join(F.slice(toks, i * size + 1, F.lit(size)), " ")))


def letter_tokens(col: Column | str) -> Column:
    """Lower-cased runs of letters (any script); used for language profiles."""
    return word_tokens(F.lower(_c(col)), r"[^\p{L}]+")


def list_items(col: Column | str) -> Column:
    """Items of a list literal (``['A', "B's"]``) as ARRAY<STRING>; both quote
    kinds are accepted. Text that is not a list gives NULL."""
    return F.from_json(
        _c(col),
        "array<string>",
        {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true",
         "mode": "PERMISSIVE"},
    )


def first_of_list_literal(col: Column | str) -> Column:
    """First element of a list literal such as ``['A', "B's"]``.

    Parses the literal as a JSON array accepting both quote kinds, so an
    apostrophe inside a double-quoted item is kept. Text that is not a list,
    an empty list and NULL all give NULL.
    """
    return F.try_element_at(list_items(col), F.lit(1))


def nfc(col: Column | str) -> Column:
    """Unicode NFC normalisation (Spark SQL has no built-in for it): an
    Arrow-batched pandas UDF, meant for small dimension tables of display
    names, not for the fact rows."""
    return _nfc_udf(_c(col))


def _nfc_series(s):
    import unicodedata

    return s.map(lambda v: unicodedata.normalize("NFC", v) if isinstance(v, str) else v)


_nfc_udf = F.pandas_udf(_nfc_series, StringType())
