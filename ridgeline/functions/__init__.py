"""Column-expression helpers. All are native Catalyst expressions (no Python
workers) except ``text.nfc`` and the ``distributions`` tail probabilities,
which are Arrow-batched pandas UDFs meant for small tables."""

from ridgeline.functions.dates import as_date, clean_year
from ridgeline.functions.rules import majority_label, normalise_label
from ridgeline.functions.text import (
    chunk_chars,
    chunk_tokens,
    first_of_list_literal,
    letter_tokens,
    list_items,
    word_tokens,
)

__all__ = [
    "as_date",
    "clean_year",
    "majority_label",
    "normalise_label",
    "chunk_chars",
    "chunk_tokens",
    "first_of_list_literal",
    "letter_tokens",
    "list_items",
    "word_tokens",
]
