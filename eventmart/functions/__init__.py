from eventmart.functions.times import (  # noqa: F401
    clock_text,
    day_slot,
    day_text,
    epoch_ms,
    epoch_seconds,
    epoch_to_text,
    iso_utc,
    local_text,
    minute_text,
    parse_iso,
    seconds_to_ntz,
)
