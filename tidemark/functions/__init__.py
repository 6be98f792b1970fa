from tidemark.functions.columns import (  # noqa: F401
    epoch_to_date,
    map_labels,
    money,
    parse_date,
    range_midpoint,
    ratio,
    round_to_int,
    safe_int,
    sign_label,
    tenure_days,
)
