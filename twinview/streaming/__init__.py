"""Continuously updated views."""

from twinview.streaming.bucketed import compact_bucketed_view, drop_bucketed, latest_bucketed_view
from twinview.streaming.changelog import compact_view, drop_compacted, latest_view, read_changes, write_changes
from twinview.streaming.expiry import compact_expiring_view, live_view, start_expiring_view
from twinview.streaming.progress import progress_table, stop_after, watch_progress
from twinview.streaming.queries import (
    append_master_stream,
    append_view,
    await_for,
    publish_view,
    stop_when_idle,
    upsert_view,
)
from twinview.streaming.state import aggregate_state, keyed_state, start_state_view, state_view
from twinview.streaming.views import (
    activity_view_stream,
    closed_activity_view,
    exact_visitors_stream,
    visitor_view_stream,
)
from twinview.streaming.windows import start_window_view, window_history, window_view

__all__ = [
    "activity_view_stream", "aggregate_state", "append_master_stream", "append_view", "await_for",
    "closed_activity_view", "compact_bucketed_view", "compact_expiring_view", "compact_view",
    "drop_bucketed", "drop_compacted", "exact_visitors_stream", "keyed_state", "latest_bucketed_view", "latest_view", "live_view", "progress_table",
    "publish_view", "read_changes", "start_expiring_view", "start_state_view", "start_window_view",
    "state_view", "stop_after", "stop_when_idle", "upsert_view", "visitor_view_stream",
    "watch_progress", "window_history", "window_view", "write_changes",
]
