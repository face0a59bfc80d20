from gradus.functions.arrays import array_length, dot, drop_at, keep_where, unnest_together
from gradus.functions.scalars import (
    balanced_sum,
    fixed_text,
    guarded_ratio,
    hash_uniform,
    normalize_id,
    schema_part,
    table_part,
    year_digits,
)

__all__ = [
    "array_length",
    "balanced_sum",
    "dot",
    "drop_at",
    "fixed_text",
    "guarded_ratio",
    "hash_uniform",
    "keep_where",
    "normalize_id",
    "schema_part",
    "table_part",
    "unnest_together",
    "year_digits",
]
