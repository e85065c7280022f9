from .clean import (
    ColumnProfile,
    NoColumnsLeft,
    clean,
    drop_constant_columns,
    drop_duplicate_columns,
    drop_duplicate_rows,
    drop_null_rows,
    profile_columns,
)
from .conform import conform
from .keys import number_within
from .metrics import LoadMetrics, observed, preview
from .quality import audit_star, duplicate_keys, orphan_keys
from .star import Dimension, build_dimensions, build_fact, lookup_join

__all__ = [
    "ColumnProfile",
    "Dimension",
    "LoadMetrics",
    "NoColumnsLeft",
    "audit_star",
    "build_dimensions",
    "build_fact",
    "clean",
    "conform",
    "drop_constant_columns",
    "drop_duplicate_columns",
    "drop_duplicate_rows",
    "drop_null_rows",
    "duplicate_keys",
    "lookup_join",
    "number_within",
    "observed",
    "orphan_keys",
    "preview",
    "profile_columns",
]
