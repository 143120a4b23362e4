"""JSON encoding of score maps ``{term: score}`` and its lenient reader."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

SCORE_MAP = "map<string,double>"


def encode_scores(term: str | Column, score: str | Column) -> Column:
    """Aggregate expression: one JSON object ``{term: score, ...}`` for the
    rows of a group (used on the <= 10 published scores)."""
    t = F.col(term) if isinstance(term, str) else term
    s = F.col(score) if isinstance(score, str) else score
    return F.to_json(F.map_from_entries(F.collect_list(F.struct(t, s))))


# One whole JSON object of names and numbers, nothing after it.
_STRING = r'"(?:[^"\\\x00-\x1f]|\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4}))*+"'
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
_PAIR = rf"\s*+{_STRING}\s*+:\s*+{_NUMBER}\s*+"
SCORE_OBJECT = rf"^\s*+\{{(?:\s*+|{_PAIR}(?:,{_PAIR})*+)\}}\s*+$"


def decode_scores(value: str | Column) -> Column:
    """Parse a JSON object of numbers; anything else (array, plain text, bad
    JSON, text after the object, a value that is not a number) gives NULL, so
    the raw text can be kept alongside."""
    v = F.col(value) if isinstance(value, str) else value
    return F.when(v.rlike(SCORE_OBJECT), F.from_json(v, SCORE_MAP, {"mode": "PERMISSIVE"}))
