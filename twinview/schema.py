"""Record layouts shared by the batch and the streaming side."""

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


_STR, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()

# Field order of one tab-separated click line (fixed values).
LINE_FIELDS = ("timestamp", "referrer", "action", "prevPage", "visitor", "page", "product")

# Actions that have a counter of their own (fixed values).
PURCHASE, ADD_TO_CART, PAGE_VIEW = "purchase", "add_to_cart", "page_view"

# Keys of the inputProps map (fixed values).
SOURCE_PROPS = ("topic", "kafkaPartition", "fromOffset", "untilOffset")

VIEW_KEYS = ("product", "timestamp_hour")

ACTIVITY = _struct(
    ("timestamp_hour", _LONG),
    ("referrer", _STR),
    ("action", _STR),
    ("prevPage", _STR),
    ("visitor", _STR),
    ("page", _STR),
    ("product", _STR),
    ("inputProps", T.MapType(_STR, _STR)),
)

ACTIVITY_BY_PRODUCT = _struct(
    ("product", _STR),
    ("timestamp_hour", _LONG),
    ("purchase_count", _LONG),
    ("add_to_cart_count", _LONG),
    ("page_view_count", _LONG),
)

VISITORS_BY_PRODUCT = _struct(
    ("product", _STR),
    ("timestamp_hour", _LONG),
    ("unique_visitors", _LONG),
)

# Master dataset; the last three are its partition columns, in directory order.
MASTER_PARTITIONS = ("topic", "kafkaPartition", "timestamp_hour")
# The folder level below these: the name of the write that made the files.
MASTER_BATCH = "batch"

# Columns of a stored activity that are not its folders', in order (fixed values).
MASTER_FIELDS = ("referrer", "action", "prevPage", "page", "visitor", "product")
MASTER = _struct(
    ("referrer", _STR),
    ("action", _STR),
    ("prevPage", _STR),
    ("page", _STR),
    ("visitor", _STR),
    ("product", _STR),
    ("fromOffset", _STR),
    ("untilOffset", _STR),
    ("topic", _STR),
    ("kafkaPartition", _INT),
    ("timestamp_hour", _LONG),
)
