"""Column expressions and rule predicates."""

from ledgerlens.functions.columns import (
    ACTIVE_FLAGS,
    BEFORE_AFTER_LABELS,
    DEFAULT_REGIONS,
    DEFAULT_STATE_BUCKETS,
    DEFAULT_STATE_BUCKET_ELSE,
    ISO_DATE,
    MANAGER_NAME_PATTERN,
    after,
    bucket,
    date_text,
    is_missing,
    longer_than,
    money_to_double,
    negative,
    not_convertible,
    not_matching,
    outside_domain,
    when_active,
    widen_key,
    zero_if_null,
)

__all__ = [
    "ACTIVE_FLAGS",
    "BEFORE_AFTER_LABELS",
    "DEFAULT_REGIONS",
    "DEFAULT_STATE_BUCKETS",
    "DEFAULT_STATE_BUCKET_ELSE",
    "ISO_DATE",
    "MANAGER_NAME_PATTERN",
    "after",
    "bucket",
    "date_text",
    "is_missing",
    "longer_than",
    "money_to_double",
    "negative",
    "not_convertible",
    "not_matching",
    "outside_domain",
    "when_active",
    "widen_key",
    "zero_if_null",
]
