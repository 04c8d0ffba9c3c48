from strata.functions.scalars import (  # noqa: F401
    iso_utc_offset,
    iso_utc_z,
    json_array,
    json_text,
    lookup_key,
    parse_iso_instant,
    run_id,
    slug,
    to_decimal,
)
