from tidemark.functions.scalars import (  # noqa: F401
    any_not_null, ascii_bucket, closed_won, epoch_ms_to_s, latest_stage, parse_time,
    to_bool, to_epoch_long, touch_point,
)
