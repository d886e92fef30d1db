from .coding import age_ordinal, diagnosis_group, with_diagnosis_groups
from .counting import absence_flag, count_in, count_not_equal, or_else, presence_flag, recode
from .nulls import DEFAULT_NULL_TOKENS, nan_to_null, null_markers, null_tokens
from .numeric import clip_upper, lenient_double, null_safe_sum, strict_bigint
from .scoring import alert_count, fixed_decimals, flag_at, platt

__all__ = [
    "DEFAULT_NULL_TOKENS", "absence_flag", "age_ordinal", "alert_count", "clip_upper", "count_in",
    "count_not_equal", "diagnosis_group", "fixed_decimals", "flag_at", "lenient_double", "nan_to_null",
    "null_markers", "null_safe_sum", "null_tokens", "or_else", "platt", "presence_flag", "recode", "strict_bigint",
    "with_diagnosis_groups",
]
