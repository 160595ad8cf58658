from .scalar import (  # noqa: F401
    fill0, fmt_date, icontains, label, map_code, norm_key, nullify, parse_iso,
    parse_num, parse_ymd, pct_diff, per, rate, ratio_zero_as_one, require_int,
    round_even, row_max, row_min, to_nullable_int,
)
