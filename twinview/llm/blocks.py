"""Documents dealt to blocks that ask slices of a key space about their keys.

Operators that must know which keys occur in other documents work in rounds: each block of
documents sends its keys to the slices of the key space that they fall into, and each slice answers
about the keys that it was asked for. Blocks are groups of a hash, so a block meets its answers
again by its number; all rounds read one shuffle of the texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

BLOCK_BYTES = 4 << 20


def deal(docs: DataFrame, keep: list[str], text: str = "text", block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int]:
    """Rows (block, doc, doc_id, text) of ``docs``, and the number of blocks, by size of the texts.

    ``doc`` is a struct of the columns ``keep``. The block depends on id and text alone.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    kept = F.struct(*(F.col(c) for c in keep)) if keep else F.struct(F.lit(0).alias("none"))
    return docs.select(
        F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).alias("block"), kept.alias("doc"),
        F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text")), blocks


def ordered(block: pa.Table) -> pa.Table:
    """A block's rows by id (null first) and text: the same in every round."""
    return block.sort_by([("doc_id", "ascending"), ("text", "ascending")], null_placement="at_start")


def ids_of(block: pa.Table) -> np.ndarray:
    """Ids as numbers that sort like them; null is the least."""
    return block["doc_id"].combine_chunks().fill_null(np.iinfo(np.int64).min).to_numpy()


def empty(schema: T.StructType) -> pa.Table:
    return to_arrow_schema(schema).empty_table()


def first_ones(keys: list[np.ndarray], owners: np.ndarray) -> np.ndarray:
    """Of entries with equal keys (one array for each part of the key), which has the least owner;
    of equal owners the first entry."""
    by = np.argsort(owners, kind="stable")
    order = by[np.argsort(keys[0][by], kind="stable")]
    same = keys[0][order][1:] == keys[0][order][:-1]
    if len(keys) > 1 and any(((k[order][1:] != k[order][:-1]) & same).any() for k in keys[1:]):
        order = np.lexsort((owners, *keys[::-1]))
        same = np.logical_and.reduce([k[order][1:] == k[order][:-1] for k in keys])
    out = np.empty(len(order), bool)
    out[order] = np.concatenate([[True], ~same]) if len(order) else True
    return out

