from tidemark.functions.columns import (  # noqa: F401
    bool_from_text, day_name, exact_sum, mean_of, month_name, range_bin_label, range_bin_lower,
    season, table_name_from_file, uri_segment, safe_ratio, null_tokens_to_null,
)
