"""Readers."""

from twinview.sources.dimensions import read_products, read_referrers
from twinview.sources.events import events_to_activity, read_events
from twinview.sources.lines import kafka_options, read_click_lines, read_click_stream
from twinview.sources.master import (
    latest_offsets,
    latest_offsets_of,
    query_path,
    read_master,
    read_view,
    starting_offsets_json,
)

__all__ = [
    "events_to_activity", "kafka_options", "latest_offsets", "latest_offsets_of", "query_path", "read_click_lines",
    "read_click_stream", "read_events", "read_master", "read_products", "read_referrers",
    "read_view", "starting_offsets_json",
]
