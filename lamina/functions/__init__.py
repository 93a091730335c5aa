from lamina.functions.exprs import (  # noqa: F401
    ALL_LABEL,
    NOT_APPLICABLE,
    NOT_INFORMED,
    OUTCOME_LABELS,
    PRESENCE_LABELS,
    SEGMENT_LABELS,
    UNKNOWN,
    decode,
    fill_code,
    fill_text,
    percent,
    ratio,
    risk_tier,
    round_fine,
    round_half_up,
    threshold_flag,
)
