"""Near-duplicates by minhash signatures and a multi-index Hamming join.

A text's signature is ``CHUNKS * CHUNK`` minhash values of 16 bits each. Signatures that differ in
at most 2 * CHUNKS - 1 values have, by the pigeonhole principle, a chunk that differs in one value at
most; each chunk therefore goes to the index once for each place at which that value may be,
with the place left out. So no pair within that distance has no bucket in common. At the similarity
linked (0.8) a chunk has one error at most with probability 0.58, and 16 chunks miss a pair beyond
the distance with probability 1e-6; it differs in more than ``NEAR`` values with probability 2e-7.

Texts of equal shingles are one class from the start. All pairs of a bucket that are near (at most
``NEAR`` values apart) end in one cluster, though a bucket isn't multiplied out:

* its least and greatest class, found by an aggregation with a map-side part, are its leaders: every
  other class meets these two, and is linked to those that are near;
* what is near a class within ``CORE`` of a leader is within NEAR + CORE of this leader. So only classes
  between NEAR and NEAR + CORE from a leader ask those in its core (``_rings``);
* classes outside of both leaders' cores ask all the others of their bucket that are, too (``_rest``).

Both questions are asked with whole signatures, in blocks of a bounded size, and answered with links
enough to connect what is near. The components are clusters, in which every pair to be found lies.
Clusters are then compared exactly, on the full sets: small ones whole, large ones in blocks, where
what some hubs connect is not compared again (``_links_of``). Only a spanning forest of the
confirmed links leaves a task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from twinview.llm.arrow import LOWER, mapped, mixed, pieces, releasing, spans_hashed, texts_of, window_starts, windows_hashed, words_of
from twinview.llm.components import components
from twinview.session import new_table_dir

SHINGLE = 5  # words
PERCENT = 80  # of the union that the intersection must have

CHUNK, CHUNKS = 7, 16
VALUES = CHUNK * CHUNKS
#: Of 112 values 22.4 differ on average at a similarity of 0.8, with a deviation of 4.2.
NEAR = 45
CORE = 21
BLOCK_ROWS = 4096  # signatures of a side that meet in one group
GROUP_ROWS = 1 << 13  # in small groups that are met in one call
BLOCK_SHINGLES = 1 << 17
GROUP_SHINGLES = 1 << 18
HUBS = 12

_MULTIPLIERS = np.random.default_rng(20).integers(0, 1 << 32, VALUES, dtype=np.uint32) | np.uint32(1)
_OFFSETS = np.random.default_rng(21).integers(0, 1 << 32, VALUES, dtype=np.uint32)


def shingles(column: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingles (hashes) of each text, and where each text's begin.

    A-Z are lowered. A text with words, but fewer than ``width``, has the sequence of all as one.
    """
    texts = texts_of(column)
    words = words_of(texts)
    hashes = spans_hashed(LOWER[texts.data], words.starts, words.ends)
    at = window_starts(words.counts, words.bounds, width)
    found, owner = windows_hashed(hashes, width)[at] if len(at) else hashes[:0], np.searchsorted(words.bounds, at, "right") - 1
    for few in range(1, width):
        short = np.flatnonzero(words.counts == few)
        if len(short):
            found = np.concatenate([found, windows_hashed(hashes, few, 1)[words.bounds[short]]])
            owner = np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.concatenate([[True], (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])]) if len(found) else np.zeros(0, bool)
    return found[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def signatures(found: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A row of ``VALUES`` minhash values for each text; zeros for an empty set."""
    out = np.zeros((len(bounds) - 1, VALUES), np.uint16)
    some = np.flatnonzero(np.diff(bounds))
    if len(some):
        first, short = bounds[some], (mixed(found, 2) >> np.uint64(32)).astype(np.uint32)
        for i in range(VALUES):
            drawn = short * _MULTIPLIERS[i] + _OFFSETS[i]
            drawn ^= drawn >> np.uint32(15)
            drawn *= np.uint32(0x2C1B3C6D)
            drawn ^= drawn >> np.uint32(12)
            # the low bits: the high ones of a large set's minimum are all zero
            out[some, i] = np.minimum.reduceat(drawn, first).astype(np.uint16)
    return out


def _binary(rows: np.ndarray) -> pa.Array:
    """Rows of a matrix as binaries."""
    width = rows.shape[1] * rows.itemsize
    offsets = np.arange(len(rows) + 1, dtype=np.int32) * width
    return pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(rows).tobytes())])


def sketches(docs: DataFrame, shingle: int = SHINGLE, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, class, signature): equal classes are equal sets of shingles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, text):
            found, bounds = shingles(batch.column(text), shingle)
            sums = np.zeros((len(bounds) - 1, 2), np.uint64)
            some = np.flatnonzero(np.diff(bounds))
            if len(some):
                for i in range(2):
                    sums[some, i] = np.add.reduceat(mixed(found, i), bounds[some])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(np.diff(bounds)), _binary(sums), _binary(signatures(found, bounds))],
                ["doc_id", "n_shingles", "class", "signature"])

    return mapped(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), text), run, "doc_id long, n_shingles long, class binary, signature binary")


def _index_keys(values: np.ndarray) -> np.ndarray:
    """For each signature, a key for each chunk and place left out."""
    out = np.empty((len(values), VALUES), np.uint64)
    wide = values.astype(np.uint64)
    for chunk in range(CHUNKS):
        for without in range(CHUNK):
            key = np.full(len(values), chunk * CHUNK + without, np.uint64)
            for place in range(CHUNK):
                if place != without:
                    key = mixed(key ^ (wide[:, chunk * CHUNK + place] << np.uint64(20)), 1)
            out[:, chunk * CHUNK + without] = key
    return out


def _entries(classes: DataFrame) -> DataFrame:
    """The index: (key, id) of every class (id, signature) and each of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = texts_of(batch.column("signature"))
            keys = _index_keys(np.frombuffer(whole.data.tobytes(), np.uint16).reshape(-1, VALUES))
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * VALUES)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(offsets, pa.array(keys.reshape(-1).view(np.int64)))], ["id", "keys"])

    return mapped(classes.select("id", "signature"), run, "id long, keys array<long>").select(F.explode("keys").alias("key"), "id")


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Pairs (id, leader) with the number of values ``apart``, if they are at most NEAR + CORE."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (np.frombuffer(texts_of(batch.column(c)).data.tobytes(), np.uint16).reshape(-1, VALUES) for c in ("x", "y"))
            apart = (left != right).sum(1).astype(np.int32)
            near = pa.array(apart <= NEAR + CORE)
            yield pa.RecordBatch.from_arrays([c.filter(near) for c in (batch.column("id"), batch.column("leader"), pa.array(apart))], ["id", "leader", "apart"])

    joined = pairs.join(classes.select("id", F.col("signature").alias("x")), "id")
    joined = joined.join(classes.select(F.col("id").alias("leader"), F.col("signature").alias("y")), "leader")
    return mapped(joined.select("id", "leader", "x", "y"), run, "id long, leader long, apart int")


def _met(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links (a, b) that connect what near pairs of one group connect: of an id that asks and one asked.

    ``rows``: (key, id, asks, asked), a group is a key. Both sides of a large one are dealt to blocks, each
    of which meets all blocks of the other side.
    """
    sized = rows.groupBy("key").agg(F.count_if("asks").alias("n_asks"), F.count_if("asked").alias("n_asked")).where("n_asks > 0 and n_asked > 0")
    whole = sized.agg(F.sum(F.col("n_asks") + F.col("n_asked"))).first()[0] or 0
    groups = max(1, -(-whole // GROUP_ROWS))
    sized = sized.select("key", *(F.ceil(F.col(n) / BLOCK_ROWS).cast("int").alias(to) for n, to in (("n_asks", "i_all"), ("n_asked", "j_all"))))
    placed = rows.join(sized, "key").withColumn("big", (F.col("i_all") > 1) | (F.col("j_all") > 1))
    none, no = F.lit(0), F.lit(False)
    small = placed.where(~F.col("big")).select(
        F.pmod(F.xxhash64("key"), F.lit(groups)).alias("part"), "big", none.alias("i"), none.alias("j"), "key", "id", "asks", "asked")

    def dealt(side: str, seed: int, n: str, i: str, other: str, j: str) -> DataFrame:
        own = F.pmod(F.xxhash64("id", F.lit(seed)), F.col(n)).cast("int")
        of_side = placed.where(F.col("big") & F.col(side)).withColumn(i, own).withColumn(j, F.explode(F.sequence(F.lit(0), F.col(other) - 1)))
        return of_side.select(F.col("key").alias("part"), "big", "i", "j", "key", "id",
                              *(F.col(c) if c == side else no.alias(c) for c in ("asks", "asked")))

    large = dealt("asks", 0, "i_all", "i", "j_all", "j").unionAll(dealt("asked", 1, "j_all", "j", "i_all", "i"))

    @releasing
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by("key")
        keys, ids, asks, asked = (group[c].to_numpy() for c in ("key", "id", "asks", "asked"))
        values = np.frombuffer(texts_of(group["signature"]).data.tobytes(), np.uint16).reshape(-1, VALUES)
        edges = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
        links: set[tuple[int, int]] = set()
        for first, last in zip(edges[:-1].tolist(), edges[1:].tolist()):
            side = slice(first, last)
            links.update(_near_forest(values[side], ids[side], np.flatnonzero(asks[side]), np.flatnonzero(asked[side])))
        found = np.array(sorted(links), np.int64).reshape(-1, 2)
        return pa.table({"a": found[:, 0], "b": found[:, 1]})

    both = small.unionAll(large).join(classes.select("id", "signature"), "id")
    return both.groupBy("part", "big", "i", "j").applyInArrow(run, "a long, b long")


def _near_forest(values: np.ndarray, ids: np.ndarray, asks: np.ndarray, asked: np.ndarray) -> list[tuple[int, int]]:
    """Links (a < b) that connect what near pairs of an asking and an asked signature connect."""
    root, out, others = np.arange(len(ids)), [], values[asked]
    for a in asks.tolist():
        near = asked[(others != values[a]).sum(1) <= NEAR]
        mine = root[a]
        for other in np.unique(root[near]).tolist():
            if other != mine:
                b = near[root[near] == other][0]
                if ids[a] != ids[b]:
                    out.append((int(min(ids[a], ids[b])), int(max(ids[a], ids[b]))))
                root[root == other] = mine
    return out


def _rings(links: DataFrame, classes: DataFrame) -> DataFrame:
    """Near pairs of classes in a leader's core with those beyond NEAR from it.

    The leader itself is in its core, but is near none of these.
    """
    core, ring = F.col("apart") <= CORE, F.col("apart") > NEAR
    asked = links.where(core | ring).select(F.col("leader").alias("key"), "id", ring.alias("asks"), core.alias("asked"))
    return _met(asked, classes)


def _rest(stars: DataFrame, links: DataFrame, classes: DataFrame) -> DataFrame:
    """Near pairs of classes that are in no core of the leaders of a bucket they share."""
    rest, settled = stars.where("id <> first and id <> last"), links.where(F.col("apart") <= CORE)
    for leader in ("first", "last"):
        rest = rest.join(settled.select("id", F.col("leader").alias(leader)), ["id", leader], "left_anti")
    yes = F.lit(True)
    return _met(rest.select("key", "id", yes.alias("asks"), yes.alias("asked")), classes)


def candidates(classes: DataFrame, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links (a, b) of classes (id, signature) whose components hold every near pair that shares a bucket."""
    leaders = _entries(classes).groupBy("key").agg(F.min("id").alias("first"), F.max("id").alias("last")).where("first <> last")
    stars = written(_entries(classes).join(leaders, "key"), "stars")
    pairs = stars.select("id", F.explode(F.array("first", "last")).alias("leader")).where("id <> leader").distinct()
    links = written(_apart(pairs, classes), "apart")
    near = links.where(F.col("apart") <= NEAR).select(F.least("id", "leader").alias("a"), F.greatest("id", "leader").alias("b"))
    return written(near.unionAll(_rings(links, classes)).unionAll(_rest(stars, links, classes)).distinct(), "links")


def _forest(found: np.ndarray, bounds: np.ndarray, ids: np.ndarray, side: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Links enough to connect what pairs at or above the similarity connect: all pairs of texts or,
    if some are on side 1, those of these with the ones on side 0."""
    parent = list(range(len(ids)))

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    sizes, out = np.diff(bounds), []
    owner = np.repeat(np.arange(len(ids)), sizes)
    order = np.argsort(found, kind="stable")  # postings: the texts that have each shingle, in order
    values, begin = np.unique(found[order], return_index=True)
    begin = np.append(begin, len(found))
    postings, code = owner[order], np.searchsorted(values, found)
    two, others = side.any(), side == 0
    for a in np.flatnonzero(side) if two else range(len(ids)):
        if not sizes[a]:
            continue
        own = code[bounds[a] : bounds[a + 1]]
        count = begin[own + 1] - begin[own]
        after = np.cumsum(count)
        where = np.repeat(begin[own] - (after - count), count) + np.arange(int(after[-1]))
        shared = np.bincount(postings[where], minlength=len(ids))
        near = 100 * shared >= percent * (sizes[a] + sizes - shared)
        for b in np.flatnonzero(near & others if two else near).tolist():
            x, y = root(int(a)), root(b)
            if x != y:
                parent[max(x, y)] = min(x, y)
                out.append((int(ids[a]), int(ids[b])))
    return out


def _confirmed(members: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links (a, b) that connect what exact comparison connects in each cluster.

    ``members``: (big, part, i, j, cluster, side, id, text); a group is some small clusters, or of a
    big one the block j and those on side 1 (of block i) that it is compared with.
    """
    @releasing
    def run(group: pa.Table) -> pa.Table:
        group = group.sort_by([("cluster", "ascending"), ("id", "ascending")])
        found, bounds = shingles(group["text"], shingle)
        clusters, ids, side = (group[c].to_numpy() for c in ("cluster", "id", "side"))
        edges = np.flatnonzero(np.concatenate([[True], clusters[1:] != clusters[:-1], [True]]))
        links = []
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
            if b - a > 1:
                at = bounds[a : b + 1]
                links += _forest(found[at[0] : at[-1]], at - at[0], ids[a:b], side[a:b], percent)
        return pa.table({"a": pa.array([x for x, _ in links], pa.int64()), "b": pa.array([y for _, y in links], pa.int64())})

    return members.groupBy("big", "part", "i", "j").applyInArrow(run, "a long, b long")


def _links_of(nodes: DataFrame, pairs: DataFrame, shingle: int, percent: int, written: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """Links (a, b) that connect what all pairs of each cluster connect.

    ``nodes``: (id, cluster, n, text); ``pairs``: those that made the clusters. A small cluster is
    compared whole. In a big one every node first meets some hubs: the one with most pairs, and some
    by chance. What that connects to the largest part needs no more comparing within it; only
    the nodes outside of it meet all others. So a group of very many copies costs what its
    size is, but for the few that are like none of the hubs.
    """
    sizes = nodes.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("blocks"), F.sum("n").alias("total"))
    whole, most = sizes.agg(F.sum("total"), F.max("blocks")).first()
    groups = max(1, -(-(whole or 0) // GROUP_SHINGLES))
    names = nodes.select("id", "cluster", "n").join(sizes.select("cluster", "blocks"), "cluster")
    small, big = names.where("blocks <= 1"), names.where("blocks > 1")
    block = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")

    def place(rows: DataFrame, side: int, i: Column, j: Column, is_big: bool = True) -> DataFrame:
        part = F.col("cluster") if is_big else F.pmod(F.xxhash64("cluster"), F.lit(groups))
        return rows.select("id", "cluster", F.lit(side).alias("side"), F.lit(is_big).alias("big"), part.alias("part"), i.alias("i"), j.alias("j"))

    def compared(placed: DataFrame, name: str) -> DataFrame:
        return written(_confirmed(placed.join(nodes.select("id", "cluster", "text"), ["id", "cluster"]), shingle, percent), name)

    def up_to(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0), n - 1))

    none = F.lit(0)
    if (most or 0) <= 1:
        return compared(place(small, 0, none, none, False), "confirmed")
    met = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("met"))
    drawn = [F.min_by("id", F.xxhash64("id", F.lit(i))) for i in range(HUBS)]
    hubs = big.join(met, "id").groupBy("cluster", "blocks").agg(F.array_distinct(F.array(F.max_by("id", "met"), *drawn)).alias("ids"))
    hubs = hubs.select("cluster", "blocks", F.explode("ids").alias("id")).withColumn("j", up_to(F.col("blocks")))
    first = compared(
        place(small, 0, none, none, False).unionAll(place(big, 0, none, block)).unionAll(place(hubs, 1, none, F.col("j"))), "confirmed")

    reached = components(first).withColumnRenamed("node", "id")
    parts = written(big.join(reached, "id", "left").withColumn("component", F.coalesce("component", "id")), "parts")
    largest = parts.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("size"))
    largest = largest.groupBy("cluster").agg(F.max_by("component", F.struct("size", "component")).alias("largest"))
    outside = parts.join(largest, "cluster").where("component != largest").select("id", "cluster", "n", "blocks")
    more = outside.groupBy("cluster").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).cast("int").alias("others"))
    own = F.pmod(F.xxhash64("id", F.lit(1)), F.col("others")).cast("int")
    asking = place(outside.join(more, "cluster").withColumn("j", up_to(F.col("blocks"))), 1, own, F.col("j"))
    asked = place(big.join(more, "cluster").withColumn("i", up_to(F.col("others"))), 0, F.col("i"), block)
    return first.unionAll(compared(asking.unionAll(asked), "rest"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT, text: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``.

    Documents are linked if their sets of distinct shingles (``shingle`` words, A-Z lowered) have
    100 * intersection >= percent * union. component_id: the smallest doc_id that links reach, its
    own included; kept: they are the same. Null and empty texts and those without a word have no
    shingles and no links. Rows of one doc_id are one document, linked if any of them is; repeated
    rows stay. Rows without a doc_id are linked with nothing, their component is null and they
    are kept. A text over ``PIECE_BYTES`` is worked on alone, with arrays of many times its size. Other
    columns are left out. No rows give no rows. Intermediate tables are written to the
    shared folder.
    """
    spark = docs.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = new_table_dir(spark, f"near-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = written(sketches(docs, shingle, text), "rows")
    with_sets = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    classes = written(with_sets.groupBy("class").agg(
        F.min("doc_id").alias("id"), F.first("signature").alias("signature"), F.first("n_shingles").alias("n")), "classes")
    links = candidates(classes, written)
    clusters = components(links).withColumnRenamed("node", "id").withColumnRenamed("component", "cluster")

    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col(text).alias("text"))
    sized = clusters.join(classes.groupBy("id").agg(F.sum("n").alias("n")), "id")
    nodes = written(sized.join(texts, "id"), "nodes")
    links = _links_of(nodes, links, shingle, percent, written)

    several = with_sets.groupBy("doc_id").agg(F.min("class").alias("x"), F.max("class").alias("y")).where("x != y").select("doc_id")
    of_one = with_sets.select("doc_id", "class").join(several, "doc_id").join(classes.select("class", "id"), "class")
    links = links.unionAll(of_one.select(F.col("doc_id").alias("a"), F.col("id").alias("b")))
    reached = components(written(links, "confirmed")).withColumnRenamed("node", "id")

    of_class = classes.select("class", "id").join(reached, "id", "left")
    least = of_class.select("class", F.coalesce("component", "id").alias("component"))
    joined = rows.join(least, (rows["class"] == least["class"]) & (rows["n_shingles"] > 0) & rows["doc_id"].isNotNull(), "left")
    component = F.coalesce(F.col("component"), F.col("doc_id"))
    return joined.select("doc_id", "n_shingles", component.alias("component_id"),
                         F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op2_hamming_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates of all documents on shingles of two words."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=2)


ORACLE = f"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS words
  FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(words, i, i + 1), ' ') AS shingle
  FROM (SELECT doc_id, words, unnest(generate_series(1, greatest(len(words) - 1, 1))) AS i FROM texts WHERE len(words) > 0)),
sizes AS (SELECT doc_id, count(shingle) AS n FROM texts LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY ALL),
links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * common >= {PERCENT} * (x.n + y.n - common)),
ways AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached(doc_id, other) AS (
  SELECT doc_id, doc_id FROM sizes
  UNION
  SELECT r.doc_id, w.b FROM reached r JOIN ways w ON r.other = w.a)
SELECT doc_id, any_value(n) AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reached JOIN sizes USING (doc_id) GROUP BY doc_id"""
