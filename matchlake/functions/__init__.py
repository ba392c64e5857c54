from matchlake.functions.columns import (  # noqa: F401
    absolute_url,
    coerce_date,
    coerce_number,
    count_or_zero,
    count_where,
    derive_result,
    hash_id,
    number_or_zero,
    presence_flag,
    round_to,
    safe_ratio,
    score_part,
    slug,
    strip_text,
    truth_flag,
    without_thousands,
)
