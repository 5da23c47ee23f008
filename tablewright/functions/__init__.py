from tablewright.functions.scalars import (  # noqa: F401
    backoff_wait, cap_text, date_text, epoch_millis, name_last_part,
    name_part_count, request_id, run_id_now, strip_dollar, ts_text,
)
from tablewright.functions.params import bind_sql, placeholders  # noqa: F401
