from .casts import assign
from .compare import canonical, comparable, identical
from .names import column, quote
from .parse import decode, parse_json, split_bad_records

__all__ = [
    "assign",
    "canonical",
    "column",
    "comparable",
    "decode",
    "identical",
    "parse_json",
    "quote",
    "split_bad_records",
]
