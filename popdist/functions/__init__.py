"""Column functions (text and numeric), all built-in Spark expressions."""

from .numeric import dosage_frequency, dosage_period, share
from .text import (
    code_key,
    decode_gender,
    json_key_values,
    none_text,
    normalize_name,
    remark_line,
    text_greater,
    text_to_int_prefix,
    title_case,
)

__all__ = [
    "code_key", "decode_gender", "dosage_frequency", "dosage_period", "json_key_values",
    "none_text", "normalize_name", "remark_line", "share", "text_greater", "text_to_int_prefix", "title_case",
]
