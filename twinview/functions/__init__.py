"""Column expressions."""

from twinview.functions.lines import epoch_ms, line_fields, tab_line
from twinview.functions.measures import action_count, views_per_purchase
from twinview.functions.time import DAY_MS, HOUR_MS, MINUTE_MS, bucket, bucket_label

__all__ = [
    "DAY_MS", "HOUR_MS", "MINUTE_MS",
    "action_count", "bucket", "bucket_label", "epoch_ms", "line_fields", "tab_line",
    "views_per_purchase",
]
