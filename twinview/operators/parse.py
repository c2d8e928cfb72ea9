"""Click lines to activities and back. All row by row: the same code serves batch and stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from twinview.functions import HOUR_MS, bucket, epoch_ms, line_fields, tab_line
from twinview.schema import ACTIVITY, LINE_FIELDS


def _well_formed(fields: Column) -> Column:
    return F.size(fields) == len(LINE_FIELDS)


def _split_once(value: str) -> Column:
    """Column ``fields``. As the output of a generator it is computed once per line; as a plain
    column the optimizer would put a split of its own into every filter and field."""
    return F.explode(F.array(line_fields(value))).alias("fields")


def parse_activity(
    lines: DataFrame, bucket_ms: int = HOUR_MS, on_bad_ts: str = "drop", value: str = "value"
) -> DataFrame:
    """Activities of the lines with exactly seven fields; other lines are left out.

    A timestamp that is no number leaves its line out as well or, with ``on_bad_ts="fail"``, fails
    the query. ``inputProps`` is passed through if the input has it, else it is an empty map.
    """
    if on_bad_ts not in ("drop", "fail"):
        raise ValueError(f"on_bad_ts is 'drop' or 'fail', not {on_bad_ts!r}")
    no_props = F.create_map().cast(ACTIVITY["inputProps"].dataType)
    props = F.col("inputProps") if "inputProps" in lines.columns else no_props
    fields = lines.select(_split_once(value), props.alias("inputProps"))
    named = fields.where(_well_formed(F.col("fields"))).select(
        *(F.get("fields", F.lit(i)).alias(name) for i, name in enumerate(LINE_FIELDS)), "inputProps"
    )
    ts = epoch_ms(F.col("timestamp"), strict=on_bad_ts == "fail")
    judged = named.select("*", F.explode(F.array(ts)).alias("ts"))  # once per line, like the split
    activity = judged.withColumn("timestamp_hour", bucket("ts", bucket_ms))
    if on_bad_ts == "drop":
        activity = activity.where(F.col("ts").isNotNull())
    return activity.select(*ACTIVITY.names)


def malformed_lines(lines: DataFrame, value: str = "value") -> DataFrame:
    """The lines ``parse_activity`` leaves out, and why."""
    fields = F.col("fields")
    reason = F.when(
        fields.isNull() | ~_well_formed(fields), F.lit("field_count")
    ).when(epoch_ms(F.get(fields, F.lit(0))).isNull(), F.lit("bad_timestamp"))
    judged = lines.select(F.col(value).alias("value"), _split_once(value))
    return judged.select("value", reason.alias("reason")).where(F.col("reason").isNotNull())


def encode_activity(activity: DataFrame, timestamp: str = "ts_ms") -> DataFrame:
    """One line per activity, in column ``value``: the inverse of ``parse_activity``."""
    columns = [F.col(timestamp), *map(F.col, LINE_FIELDS[1:])]
    return activity.select(tab_line(*columns).alias("value"))
