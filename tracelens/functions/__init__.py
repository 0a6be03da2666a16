from tracelens.functions.keys import concat_key, split_key
from tracelens.functions.missing import (
    NA,
    as_missing,
    is_present,
    label_missing,
    missing_if_equal,
)
from tracelens.functions.arith import (
    clamp,
    ratio,
    round_half_even,
    round_even_sql,
    round_half_up,
    round_sql,
    scale_round,
)

__all__ = [
    "NA", "as_missing", "clamp", "concat_key", "is_present", "label_missing",
    "missing_if_equal", "ratio", "round_even_sql", "round_half_even", "round_half_up", "round_sql", "scale_round", "split_key",
]
