from duelframe.functions.columns import (  # noqa: F401
    anomaly_confidence, columns_containing, concat_null, drop_existing, existing,
    numeric_columns, prefix_columns, round_even, safe_ratio, select_existing,
    string_columns, upper_columns, weekday_monday0,
)
