"""JSON column helpers.

JSON payloads stay text in the log; fields are read with ``from_json`` against
schemas whose leaves are all strings (PostgreSQL ``->>`` semantics: numbers and
booleans become text) and then cast where a type is wanted.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from farelake.schemas import REQUEST_SCHEMA, RESPONSE_SCHEMA


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_len(doc, path: str = "$.data") -> Column:
    """Number of elements of a JSON array at ``path``; 0 when missing or not an array."""
    return F.coalesce(F.json_array_length(F.get_json_object(_c(doc), path)), F.lit(0))


def quoted_json_text(text) -> Column:
    """A JSON string literal of a text column (``to_json`` rejects bare strings)."""
    array = F.to_json(F.array(_c(text)))
    return F.when(_c(text).isNotNull(), F.substring(array, F.lit(2), F.length(array) - 2))


def parse_request(doc) -> Column:
    """Struct of the request fields the ODS reads (all text)."""
    return F.from_json(_c(doc), REQUEST_SCHEMA)


def parse_response(doc) -> Column:
    """Struct ``{success, error, currency, data: array<offer>}``; NULL data for a
    string response, a missing ``data`` key or a non-array ``data``."""
    return F.from_json(_c(doc), RESPONSE_SCHEMA)
