from tabrisk.functions.columns import (  # noqa: F401
    argmax_first,
    bin_left_closed,
    bin_right_closed,
    clip_lower,
    coerce_double,
    flag,
    guarded_ratio,
    hash_key,
    hash_unit,
    interval_flag,
    nan_to_null,
    ordinal_map,
    round_half_even,
    strip_ws,
    weighted_sum,
)
