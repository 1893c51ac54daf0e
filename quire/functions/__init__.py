from quire.functions.scalars import (  # noqa: F401
    archive_file_name, is_iso_datetime, iso_text, iso_utc, lenient_int, minute_key,
    now_iso, null_to_empty, period_of, sse_payload, strict_date, to_text, utc_wall_clock,
)
from quire.functions.json import (  # noqa: F401
    decode, encode, json_field, parse_once, python_text,
)
