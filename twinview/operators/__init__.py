"""DataFrame operators."""

from twinview.operators.parse import encode_activity, malformed_lines, parse_activity
from twinview.operators.props import (
    flatten_props,
    with_file_props,
    with_record_props,
    with_source_props,
)
from twinview.operators.reports import (
    compare_visitors,
    labelled_buckets,
    preview,
    register,
    views_by_name_length,
)
from twinview.operators.snapshots import last_per_key, last_per_window
from twinview.operators.views import (
    activity_by_product,
    approx_visitors_by_product,
    approx_visitors_oneshot,
    merge_sketches,
    product_summary,
    recent,
    under_exposed,
    visitor_sketches,
    visitors_by_product,
    visitors_summary,
)

__all__ = [
    "activity_by_product", "approx_visitors_by_product", "approx_visitors_oneshot",
    "compare_visitors", "encode_activity", "flatten_props", "labelled_buckets", "last_per_key",
    "last_per_window", "malformed_lines", "merge_sketches", "parse_activity", "preview",
    "product_summary", "recent", "register", "under_exposed", "views_by_name_length",
    "visitor_sketches", "visitors_by_product", "visitors_summary", "with_file_props", "with_record_props",
    "with_source_props",
]
