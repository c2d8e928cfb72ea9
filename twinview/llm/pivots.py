"""Links between embeddings of one label by an exact metric range join.

On unit vectors a cosine of at least ``t`` is a distance of at most r = sqrt(2 - 2 t). Rows with equal
label and vector are one node from the start. The nodes of a label (and length) are a cell; a cell is
split by pivots, a few of its own nodes: a node's home is the cell of its nearest pivot, and it
visits every other cell that may hold something within r. By the triangle inequality that is at most
where d(x, q) - d(x, p) <= 2 r for its nearest pivot p; seen from the hyperplane between p and q it is
d(x, q)^2 - d(x, p)^2 <= 2 r d(p, q), which is never wider. A visitor goes if it is further than r
from the furthest home node. Cells with many home nodes are split again, with pivots of their own.

A node finds all its links in its home cell, so cells join independently. In a cell

* nodes within r / 2 of the pivot (its core) are linked to each other by the triangle inequality:
  they are counted, not compared, however many near copies there are;
* core nodes meet the others within 1.5 r of the pivot, and home nodes beyond the core meet all;
* both sides are dealt to blocks, in which nodes are sorted by distance to the pivot: parts of a
  block further apart than r are skipped, parts that are within r in any case are counted, and
  only what is in between is multiplied.

What leaves a block is a count for each node and links enough to connect what is connected in it.
On data without clusters, in many dimensions, distances are all alike and nothing can be left out:
then each split sends a node to most of the cells, and all pairs of a label are multiplied, as in any
exact join.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from twinview.llm.arrow import mapped, releasing
from twinview.llm.components import components
from twinview.session import new_table_dir

COSINE = 0.93
PIVOTS = 8  # of a cell
CELL = 4096  # home nodes beyond the core from which on a cell is split again
MOST_SPLITS = 8  # a cell is joined in blocks whatever its size, so this loses nothing
BLOCK = 4096  # rows of a side that meet in one group
PART = 512  # rows of a block that are multiplied at once
MARGIN = 1e-9  # far more than distances are rounded by, far less than a distance of interest

NODE = "cell string, node long, copies long, vec binary, home boolean, dist double"


def _distances(x: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(((x - pivot) ** 2).sum(1), 0))


def _vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Binaries of doubles, all of one length, as a matrix."""
    cells = column.to_pylist()
    return np.frombuffer(b"".join(cells), "<f8").reshape(len(cells), -1)


def _rows(vectors: DataFrame, vector: str) -> DataFrame:
    """(vec_id, label, cell, digest, vec): cell null where a vector links with nothing.

    ``vec`` is the vector as doubles, divided by its length; a digest of 128 bits tells vectors apart.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column, labels = batch.column("vector"), batch.column("label").to_pylist()
            sizes = column.value_lengths().fill_null(0).to_numpy()
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)  # a null entry is NaN
            begins = np.cumsum(sizes) - sizes
            cells, digests, units = ([None] * len(labels) for _ in range(3))
            for dims in np.unique(sizes[sizes > 0]).tolist():
                at = np.flatnonzero(sizes == dims)
                x = flat[begins[at][:, None] + np.arange(dims)]
                largest = np.abs(x).max(1)
                fine = (largest > 0) & (largest < np.inf)
                at, x = at[fine], x[fine]
                scaled = x / largest[fine][:, None]  # squares neither overflow nor vanish
                unit = scaled / np.sqrt((scaled * scaled).sum(1))[:, None]
                for row, i in enumerate(at.tolist()):
                    if labels[i] is not None:
                        cells[i] = f"{dims}|{labels[i]}"
                        digests[i] = xxhash.xxh3_128_digest(x[row].tobytes())
                        units[i] = unit[row].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(cells, pa.string()), pa.array(digests, pa.binary()), pa.array(units, pa.binary())],
                ["vec_id", "cell", "digest", "vec"])

    plain = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"),
                           F.col(vector).cast("array<double>").alias("vector"))
    return mapped(plain, run, "vec_id long, cell string, digest binary, vec binary")


def _split(rows: DataFrame, open_cells: DataFrame, level: int, radius: float) -> DataFrame:
    """Rows of the open cells (cell, salts) in the cells of their pivots, with the distance to it."""
    drawn = [F.min_by("vec", F.xxhash64("node", F.lit(level * PIVOTS + i))) for i in range(PIVOTS)]
    pivots = rows.where("home").join(open_cells.select("cell"), "cell").groupBy("cell").agg(F.array_sort(F.array_distinct(F.array(*drawn))).alias("pivots"))
    pivots = pivots.join(open_cells, "cell").withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)))
    pivots = pivots.select(F.col("cell").alias("of_cell"), F.col("salt").alias("of_salt"), "pivots")
    dealt = rows.join(open_cells, "cell").withColumn("salt", F.pmod(F.xxhash64("node", F.lit(-1)), F.col("salts")).cast("int"))

    @releasing
    def run(here: pa.Table, there: pa.Table) -> pa.Table:
        p = _vectors(pa.array([v.as_py() for v in there["pivots"][0].values], pa.binary()))
        x, home = _vectors(here["vec"]), here["home"].to_numpy()
        dist = np.stack([_distances(x, q) for q in p], 1)
        apart = np.stack([_distances(p, q) for q in p], 1)
        nearest = dist.argmin(1)
        at_home = home[:, None] & (np.arange(len(p)) == nearest[:, None])
        goes = np.ones(dist.shape, bool)
        for q in range(len(p)):
            goes &= dist**2 - dist[:, [q]] ** 2 <= 2 * radius * apart[q] + MARGIN
        who, where = np.nonzero(goes | at_home)
        cells = here["cell"].take(pa.array(who))
        return pa.table({
            "cell": pa.array([f"{c}.{q}" for c, q in zip(cells.to_pylist(), where.tolist())], pa.string()),
            **{c: here[c].take(pa.array(who)) for c in ("node", "copies", "vec")},
            "home": pa.array(at_home[who, where]), "dist": pa.array(dist[who, where])})

    narrow = dealt.select("cell", "salt", "node", "copies", "vec", "home")
    return narrow.groupBy("cell", "salt").cogroup(pivots.groupBy("of_cell", "of_salt")).applyInArrow(run, NODE)


def _unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Make the nodes ``a`` and ``b`` of each link have one root; ``parent`` holds roots before and after."""
    while True:
        a, b = parent[a], parent[b]
        low, high = np.minimum(a, b), np.maximum(a, b)
        apart = low != high
        if not apart.any():
            return
        np.minimum.at(parent, high[apart], low[apart])
        while (parent[parent] != parent).any():
            parent[:] = parent[parent]


def linked(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which pairs of unit rows have at least this cosine: in single precision, and again in double
    precision where that may have rounded across the bound."""
    slack = 1e-6 * max(16, x.shape[1])
    rough = x.astype(np.float32) @ y.astype(np.float32).T
    near = rough >= cosine
    for first in range(0, len(x), 64):
        rows, columns = np.nonzero(np.abs(rough[first : first + 64] - cosine) <= slack)
        for some in range(0, len(rows), 1 << 16):
            a, b = rows[some : some + (1 << 16)] + first, columns[some : some + (1 << 16)]
            near[a, b] = (x[a] * y[b]).sum(1) >= cosine
    return near


def _join(homes: dict, others: dict, radius: float, cosine: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links of home nodes to other rows of their cell as (node, links, other): home nodes with their
    number of links (copies counted, itself not), and links (with 0) that connect what all connect."""
    homes, others = ({k: v[np.argsort(side["dist"], kind="stable")] for k, v in side.items()} for side in (homes, others))
    nodes = np.unique(np.concatenate([homes["node"], others["node"]]))
    left, right = (np.searchsorted(nodes, side["node"]) for side in (homes, others))
    counts, parent = np.zeros(len(left), np.int64), np.arange(len(nodes))
    for i in range(0, len(left), PART):
        a = slice(i, i + PART)
        near_a, far_a = homes["dist"][a][0], homes["dist"][a][-1]
        for j in range(0, len(right), PART):
            b = slice(j, j + PART)
            near_b, far_b = others["dist"][b][0], others["dist"][b][-1]
            if max(near_a - far_b, near_b - far_a) > radius + MARGIN:
                continue
            if far_a + far_b <= radius - MARGIN:
                pairs = np.ones((len(left[a]), len(right[b])), bool)
            else:
                pairs = linked(homes["x"][a], others["x"][b], cosine)
            pairs &= left[a][:, None] != right[b]
            counts[a] += pairs @ others["copies"][b]
            who, whom = np.nonzero(pairs)
            _unite(parent, left[a][who], right[b][whom])
    moved = np.flatnonzero(parent != np.arange(len(parent)))
    some = np.flatnonzero(counts)
    return (np.concatenate([homes["node"][some], nodes[moved]]), np.concatenate([counts[some], np.zeros(len(moved), np.int64)]),
            np.concatenate([homes["node"][some], nodes[parent[moved]]]))


def _joined(rows: DataFrame, cells: DataFrame, radius: float, cosine: float) -> DataFrame:
    """(node, links, other) of final cells: counts of links, and links enough to connect (with 0)."""
    core = F.col("dist") <= radius / 2 - MARGIN
    around = F.col("dist") <= 1.5 * radius + MARGIN
    # core nodes among themselves
    cores = rows.where(core).groupBy("cell").agg(F.sum("copies").alias("all"), F.min("node").alias("first"))
    counted = rows.where(core & F.col("home")).join(cores, "cell").select("node", (F.col("all") - F.col("copies")).alias("links"), F.col("first").alias("other"))

    def blocks(n: Column) -> Column:
        return F.greatest(F.ceil(n / BLOCK), F.lit(1)).cast("int")

    def up_to(n: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(n) - 1))

    def mine(n: str, seed: int) -> Column:
        return F.pmod(F.xxhash64("node", F.lit(seed)), F.col(n)).cast("int")

    sized = cells.select("cell", F.explode(F.array(
        F.struct(F.lit(True).alias("core"), blocks(F.col("core_homes")).alias("i_all"), blocks(F.col("around")).alias("j_all"),
                 (F.col("core_homes") > 0).alias("asked")),
        F.struct(F.lit(False).alias("core"), blocks(F.col("homes")).alias("i_all"), blocks(F.col("rows")).alias("j_all"),
                 (F.col("homes") > 0).alias("asked")))).alias("s")).select("cell", "s.*").where("asked").drop("asked")
    found = ["cell", "core", "i", "j", "node", "copies", "vec", "dist", "asks"]
    asking = rows.where("home").withColumn("core", core).join(sized, ["cell", "core"])
    asking = asking.withColumn("i", mine("i_all", 1)).withColumn("j", up_to("j_all")).withColumn("asks", F.lit(True))
    meets = F.filter(F.array(F.when(~core & around, F.lit(True)), F.lit(False)), lambda x: x.isNotNull())
    asked = rows.withColumn("core", F.explode(meets)).join(sized, ["cell", "core"])
    asked = asked.withColumn("j", mine("j_all", 2)).withColumn("i", up_to("i_all")).withColumn("asks", F.lit(False))

    @releasing
    def run(group: pa.Table) -> pa.Table:
        asks = group["asks"].to_numpy()
        side = {"node": group["node"].to_numpy(), "copies": group["copies"].to_numpy(), "dist": group["dist"].to_numpy(), "x": _vectors(group["vec"])}
        homes, others = ({k: v[which] for k, v in side.items()} for which in (asks, ~asks))
        return pa.table(dict(zip(("node", "links", "other"), _join(homes, others, radius, cosine))))

    met = asking.select(*found).unionAll(asked.select(*found)).groupBy("cell", "core", "i", "j").applyInArrow(run, "node long, links long, other long")
    return counted.unionAll(met)


def _measured(rows: DataFrame, radius: float) -> tuple[DataFrame, DataFrame]:
    """Rows without visitors that are out of reach, and the cells' numbers of rows.

    homes: home nodes beyond the core; around: rows outside of it that may be linked with it.
    """
    reach = rows.where("home").groupBy("cell").agg(F.max("dist").alias("reach"))
    rows = rows.join(reach, "cell").where(F.col("home") | (F.col("dist") <= F.col("reach") + radius + MARGIN)).drop("reach")
    core = F.col("dist") <= radius / 2 - MARGIN
    cells = rows.groupBy("cell").agg(
        F.count_if(F.col("home") & core).alias("core_homes"), F.count_if(F.col("home") & ~core).alias("homes"),
        F.count_if(~core & (F.col("dist") <= 1.5 * radius + MARGIN)).alias("around"), F.count(F.lit(1)).alias("rows"))
    return rows, cells


def links_of(nodes: DataFrame, cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """(node, links, other) of ``nodes`` (cell, node, copies, vec): counts of links to other nodes'
    rows, to be summed by node, and links (node, other) that connect what all links connect."""
    spark, radius = nodes.sparkSession, float(np.sqrt(2 - 2 * cosine))

    def written(df: DataFrame, name: str) -> DataFrame:
        path = new_table_dir(spark, f"pivots-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = nodes.select("cell", "node", "copies", "vec", F.lit(True).alias("home"), F.lit(None).cast("double").alias("dist"))
    salts = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("salts")
    open_cells, done = rows.groupBy("cell").agg(salts), []
    for level in range(MOST_SPLITS):
        rows, cells = _measured(written(_split(rows, open_cells, level, radius), f"split-{level}"), radius)
        cells = written(cells, f"cells-{level}")
        again = F.col("homes") > (cell if level < MOST_SPLITS - 1 else 1 << 62)
        done.append(_joined(rows.join(cells.where(~again).select("cell"), "cell", "left_semi"), cells.where(~again), radius, cosine))
        larger = cells.where(again)
        if larger.isEmpty():
            break
        # the core is counted and joined here; below, its nodes only visit
        core = F.col("dist") <= radius / 2 - MARGIN
        here = rows.join(larger.select("cell"), "cell", "left_semi")
        done.append(_joined(here, larger.withColumn("homes", F.lit(0)), radius, cosine))
        rows = here.withColumn("home", F.col("home") & ~core)
        open_cells = larger.select("cell", F.ceil(F.col("rows") / BLOCK).cast("int").alias("salts"))
    out = done[0]
    for more in done[1:]:
        out = out.unionAll(more)
    return written(out, "links")


def near_vectors(vectors: DataFrame, vector: str = "embedding", cosine: float = COSINE, cell: int = CELL) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows are linked if their labels are equal and not null and the cosine of their vectors, in double
    precision, is ``cosine`` or more. n_links: other rows linked directly; component_id: the
    smallest vec_id of the rows that links reach, its own included; kept: they are the same.

    Vectors that are null, empty, zero, or hold null or non-finite entries link with nothing, and vectors
    of different lengths not with each other. Repeated rows are rows of their own, linked with each other;
    so are different vectors of one vec_id, linked only if they are near. A null vec_id counts among
    n_links; component_id is null, and the row kept, if none of its component has an id. Other
    columns are left out. No rows give no rows. Intermediate tables are written to the shared folder.
    """
    spark = vectors.sparkSession

    def written(df: DataFrame, name: str) -> DataFrame:
        path = new_table_dir(spark, f"pivots-{name}")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    rows = written(_rows(vectors, vector), "rows")
    same = ["cell", "digest"]
    nodes = rows.where("cell is not null").groupBy(*same).agg(
        F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"), F.first("vec").alias("vec"))
    nodes = written(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")  # read back: numbers don't change
    links = links_of(nodes.select("cell", "node", "copies", "vec"), cosine, cell)
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    reached = components(links.select(F.col("node").alias("a"), F.col("other").alias("b")))
    known = nodes.select(*same, "node", "least", "copies").join(counts, "node", "left").join(reached, "node", "left")
    known = written(known.withColumn("component", F.coalesce("component", "node")), "known")
    least = known.groupBy("component").agg(F.min("least").alias("component_id"))
    of_node = known.join(least, "component").select(
        *same, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id")
    joined = rows.select("vec_id", *same).join(of_node, same, "left")
    component = F.when(F.col("cell").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
                         F.col("vec_id").eqNullSafe(component).alias("kept"))


def op12_pivot_range_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of all embeddings of equal labels at a cosine of 0.93."""
    return near_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "label", "embedding"))


ORACLE = f"""
WITH RECURSIVE vectors AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
usable AS (
  SELECT * FROM vectors
  WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(v, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM usable a JOIN usable b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= {COSINE}),
counts AS (SELECT a AS vec_id, count(*) AS n FROM pairs GROUP BY a),
reached(vec_id, other) AS (
  SELECT vec_id, vec_id FROM vectors
  UNION
  SELECT r.vec_id, p.b FROM reached r JOIN pairs p ON r.other = p.a)
SELECT vec_id, coalesce(any_value(n), 0)::BIGINT AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
FROM reached LEFT JOIN counts USING (vec_id) GROUP BY vec_id"""
