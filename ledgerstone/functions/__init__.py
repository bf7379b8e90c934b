"""Column functions: cleaning, safe casts, masks and tokens."""

from ledgerstone.functions.clean import (  # noqa: F401
    lower_text,
    safe_bool,
    safe_date,
    safe_decimal,
    safe_int,
    safe_long,
    safe_timestamp,
    trimmed,
    upper_text,
)
from ledgerstone.functions.masks import (  # noqa: F401
    age_band,
    amount_band,
    apply_handling,
    mask_card,
    mask_email,
    mask_identifier,
    mask_phone,
    pii_counts,
    scrub_pii,
)
from ledgerstone.functions.tokens import hmac_sha256, name_token  # noqa: F401
