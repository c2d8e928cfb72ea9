"""Mixing sources to target weights: Sainte-Laguë apportionment of equal-token blocks.

Everything is DataFrame functions. The corpus is summed once by (source, shard), where a shard is
a fixed hash bucket of a source, so that a source with a third of all rows is many shards. Blocks
of ``block_tokens`` words go to sources, and a source's blocks to its shards, by highest quotient
votes / (2 j - 1). A shard takes ``max_repeat`` times its words at most; what that bound takes off its
blocks goes, word by word and again by highest quotient, to the shards of its source that are below
theirs, so a source gets its blocks' words whatever the length of its texts. Each shard's documents
stand in a seeded order on a tape that repeats; the shard takes its quota of consecutive words from a
seeded block on. Only the sums by shard are gathered; documents are shuffled once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from twinview.session import new_table_dir

# Weights of the sources in order of their names, repeating (fixed values).
WEIGHTS = (5, 2, 1)
BLOCK_TOKENS = 8
SHARDS = 4096  # of each source
MAX_REPEAT = 3
SEED = "mix-1"

WORD = r"[^\x20\x09-\x0D]+"


def _draw(*parts: Column) -> Column:
    """60 bits of MD5, the same in any engine."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 15), 16, 10).cast("long")


def _apportioned(parties: DataFrame, group: list[str], seats: str, votes: str, whole: str, order: list[str]) -> DataFrame:
    """``parties`` with their ``blocks``: Sainte-Laguë with ``seats`` seats in each group.

    With k parties, the divisors whole / (seats - k/2) and whole / (seats + k/2) bound the final
    one. What the first gives is certain; only the quotients between the two, some two for each
    party, are ranked.
    """
    each = Window.partitionBy(*group)
    half = F.count(F.lit(1)).over(each) / 2
    share = F.col(votes).cast("double") / F.nullif(F.col(whole).cast("double"), F.lit(0.0))
    bounded = parties.withColumn("_half", half)
    bounded = bounded.withColumn("_sure", F.coalesce(F.floor(share * F.greatest(F.col(seats) - F.col("_half"), F.lit(0.0)) + 0.5), F.lit(0)).cast("long"))
    bounded = bounded.withColumn("_most", F.coalesce(F.ceil(share * (F.col(seats) + F.col("_half")) + 0.5), F.lit(0)).cast("long"))
    bounded = bounded.withColumn("_open", F.col(seats) - F.sum("_sure").over(each))
    asked = bounded.withColumn("_j", F.explode_outer(F.when(F.col("_most") > F.col("_sure"), F.sequence(F.col("_sure") + 1, F.col("_most")))))
    quotient = F.col(votes).cast("double") / (2 * F.col("_j") - 1)
    rank = F.row_number().over(each.orderBy(F.col("_j").isNull(), quotient.desc(), *order, "_j"))
    won = (F.col("_j").isNotNull() & (rank <= F.col("_open")) & (F.col(votes) > 0)).cast("long")
    names = parties.columns
    return (
        asked.withColumn("_won", won).groupBy(*group, *order)
        .agg(*(F.first(c).alias(c) for c in names if c not in (*group, *order)), (F.first("_sure") + F.sum("_won")).alias("blocks"))
        .select(*names, "blocks"))


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_repeat: int = MAX_REPEAT) -> DataFrame:
    """Rows (key, source, source_size) with ``target`` and the ``whole``, by filling up to a level.

    Sources sorted by cap / weight are capped first; the level is that of the first source which
    can take what is left at its own weight.
    """
    everything = Window.partitionBy(F.lit(0))
    ordered = sizes.withColumn("_n", F.row_number().over(everything.orderBy(F.col("source").isNull(), "source")) - 1)
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("_n") % len(weights) + 1).cast("int"))
    ordered = ordered.withColumn("_w", weight).withColumn("_cap", F.col("source_size") * max_repeat)
    ordered = ordered.withColumn("_r", F.col("_cap") / F.col("_w")).withColumn("whole", F.sum("source_size").over(everything))
    by = everything.orderBy("_r", "_n")
    before = F.coalesce(F.sum("_cap").over(by.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(by.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    ordered = ordered.withColumn("_level", (F.col("whole") - before) / left).withColumn("_k", F.row_number().over(by))
    first = F.min(F.when(F.col("_level") <= F.col("_r"), F.struct("_k", "_level"))).over(everything)
    ordered = ordered.withColumn("_level", first["_level"])
    return ordered.withColumn("target", F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w"))).select(
        "_key", "source", "source_size", "target", "whole")


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, block_tokens: int = BLOCK_TOKENS,
        shards: int = SHARDS, max_repeat: int = MAX_REPEAT, seed: str = SEED, keep: list[str] | None = None) -> DataFrame:
    """Every row of ``docs`` as the struct ``doc`` (of the columns ``keep``, all by default), with
    what the mix takes of it. The sums by shard are written to the shared folder first.

    size: its words; source_size, target: of its source; taken: its words in the mix, repeats
    counted; copies: whole copies a mix of whole documents has (blocks' first words decide).

    Null and empty texts have no words and are taken 0 times; texts of any length are parted like others. A null source is a source, the
    last. Repeated rows are rows of their own; rows equal in doc_id and size may swap results.
    Null ids share one shard order. Other columns, whatever their names, stay inside ``doc``.
    An empty table gives no rows.
    """
    key = F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("n"))
    rows = docs.select(
        F.struct(*(keep or docs.columns)).alias("doc"), key.alias("_key"), "source", F.col("doc_id").alias("_id"),
        _draw(F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).alias("_draw"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    rows = rows.withColumn("_shard", F.col("_draw") % shards)

    path = new_table_dir(docs.sparkSession, "mix-sums")
    rows.groupBy("_key", "source", "_shard").agg(F.sum("size").alias("_votes")).write.parquet(path)
    sums = docs.sparkSession.read.parquet(path)
    rows = rows.drop("source")
    sizes = sums.groupBy("_key", "source").agg(F.sum("_votes").alias("source_size"))
    sources = targets(sizes, weights, max_repeat).withColumn("_all", F.lit(0))
    sources = sources.withColumn("_seats", F.round(F.col("whole") / block_tokens).cast("long"))
    sources = _apportioned(sources, ["_all"], "_seats", "target", "whole", ["_key"])
    shares = sources.select("_key", "source_size", "target", F.col("blocks").alias("_seats"))
    shares = sums.select("_key", "_shard", "_votes").join(shares, "_key")
    shares = _apportioned(shares, ["_key"], "_seats", "_votes", "source_size", ["_shard"])
    each = Window.partitionBy("_key")
    asked, most = F.col("blocks") * block_tokens, F.col("_votes") * max_repeat
    cut = shares.withColumn("_quota", F.least(asked, most)).withColumn("_room", most - F.col("_quota"))
    whole = F.least(F.sum(asked).over(each), F.col("source_size") * max_repeat)
    cut = cut.withColumn("_rest", whole - F.sum("_quota").over(each)).withColumn("_rooms", F.sum("_room").over(each))
    # as there is room for the rest, no quotient beyond a shard's room (under 1/2) wins before one within it
    given = _apportioned(cut.drop("blocks", "_seats"), ["_key"], "_rest", "_room", "_rooms", ["_shard"])
    quotas = given.select(
        "_key", "_shard", "source_size", "target", F.col("_votes").alias("_s"), (F.col("_quota") + F.col("blocks")).alias("_quota"),
        (_draw(F.lit(seed), F.col("_key"), F.col("_shard").cast("string"))
         % F.greatest(F.floor(F.col("_votes") / block_tokens), F.lit(1)) * block_tokens).alias("_from"))

    tape = Window.partitionBy("_key", "_shard").orderBy("_draw", "_id", "size")
    end = F.sum("size").over(tape.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    placed = rows.join(quotas, ["_key", "_shard"]).withColumn("_end", end).withColumn("_begin", F.col("_end") - F.col("size"))
    divisor = F.nullif(F.col("_s"), F.lit(0))
    placed = placed.withColumn("_rounds", F.coalesce(F.floor(F.col("_quota") / divisor), F.lit(0)).cast("long"))
    placed = placed.withColumn("_to", F.col("_from") + F.col("_quota") - F.col("_rounds") * F.col("_s"))

    def overlap(a: Column, b: Column) -> Column:
        return F.greatest(F.least(F.col("_end"), b) - F.greatest(F.col("_begin"), a), F.lit(0))

    def begins(a: Column, b: Column) -> Column:
        return ((F.col("_begin") >= a) & (F.col("_begin") < b) & (F.col("size") > 0)).cast("long")

    wrapped = F.col("_to") - F.col("_s")
    part = overlap(F.col("_from"), F.col("_to")) + overlap(F.lit(0), wrapped)
    whole = begins(F.col("_from"), F.col("_to")) + begins(F.lit(0), wrapped)
    return placed.select(
        "doc", "size", "source_size", "target",
        (F.col("_rounds") * F.col("size") + part).cast("long").alias("taken"),
        F.when(F.col("size") > 0, F.col("_rounds") + whole).otherwise(0).cast("long").alias("copies"))


def op3_sainte_lague_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by the weights 5, 2, 1: words taken of each."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    return mix(docs, keep=["doc_id"]).select("doc.doc_id", "size", "source_size", "target", "taken")


_APPORTION = """
{name}_bound AS (SELECT *, count(*) OVER ({over}) / 2 AS half FROM {parties}),
{name}_sure AS (
  SELECT *, coalesce(floor(votes::DOUBLE / nullif(whole::DOUBLE, 0) * greatest(seats - half, 0.0) + 0.5), 0)::BIGINT AS sure,
         coalesce(ceil(votes::DOUBLE / nullif(whole::DOUBLE, 0) * (seats + half) + 0.5), 0)::BIGINT AS most
  FROM {name}_bound),
{name}_asked AS (
  SELECT {keys}, votes, seats - sum(sure) OVER ({over}) AS open, sure, most FROM {name}_sure),
{name}_ranked AS (
  SELECT {keys}, open, row_number() OVER ({over} ORDER BY votes::DOUBLE / (2 * j - 1) DESC, {party}, j) AS place
  FROM (SELECT *, unnest(generate_series(sure + 1, most)) AS j FROM {name}_asked WHERE votes > 0)),
{name}_won AS (SELECT {keys}, count(*) AS won FROM {name}_ranked WHERE place <= open GROUP BY ALL),
{name} AS (
  SELECT s.*, sure + coalesce(won, 0) AS blocks FROM {name}_sure s LEFT JOIN {name}_won USING ({keys}))"""

_DRAW = "('0x' || substr(md5({}), 1, 15))::BIGINT"

ORACLE = f"""
WITH rows AS (
  SELECT doc_id, coalesce('s' || source, 'n') AS key, source,
         {_DRAW.format(f"'{SEED}|' || coalesce(doc_id::VARCHAR, '')")} AS draw,
         coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents),
sums AS (SELECT key, draw % {SHARDS} AS shard, any_value(source) AS source, sum(size)::BIGINT AS votes FROM rows GROUP BY ALL),
sizes AS (SELECT key, any_value(source) AS source, sum(votes)::BIGINT AS source_size FROM sums GROUP BY key),
weighed AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS w,
         row_number() OVER (ORDER BY source NULLS LAST) AS n,
         source_size * {MAX_REPEAT} AS cap, (sum(source_size) OVER ())::BIGINT AS whole
  FROM sizes),
levels AS (
  SELECT *, cap / w AS r, row_number() OVER (ORDER BY cap / w, n) AS k,
         (whole - coalesce(sum(cap) OVER (ORDER BY cap / w, n ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / (sum(w) OVER (ORDER BY cap / w, n ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM weighed),
targeted AS (
  SELECT key, source_size, whole, least(cap::DOUBLE, (SELECT arg_min(level, k) FROM levels WHERE level <= r) * w) AS target
  FROM levels),
parties AS (SELECT *, target AS votes, round(whole / {BLOCK_TOKENS})::BIGINT AS seats FROM targeted),
{_APPORTION.format(name="source_seats", parties="parties", over="", keys="key", party="key")},
shares AS (
  SELECT s.key, s.shard, s.votes, p.source_size, p.target, p.source_size AS whole, p.blocks AS seats
  FROM sums s JOIN source_seats p USING (key)),
{_APPORTION.format(name="shard_seats", parties="shares", over="PARTITION BY key", keys="key, shard", party="shard")},
cut AS (
  SELECT key, shard, source_size, target, votes AS s, blocks * {BLOCK_TOKENS} AS asked,
         least(blocks * {BLOCK_TOKENS}, votes * {MAX_REPEAT})::BIGINT AS quota, votes * {MAX_REPEAT} AS most
  FROM shard_seats),
rooms AS (
  SELECT key, shard, source_size, target, s, quota, most - quota AS votes, (sum(most - quota) OVER (PARTITION BY key))::BIGINT AS whole,
         (least(sum(asked) OVER (PARTITION BY key), source_size * {MAX_REPEAT}) - sum(quota) OVER (PARTITION BY key))::BIGINT AS seats
  FROM cut),
{_APPORTION.format(name="given", parties="rooms", over="PARTITION BY key", keys="key, shard", party="shard")},
quotas AS (
  SELECT key, shard, source_size, target, s, (quota + blocks)::BIGINT AS quota,
         {_DRAW.format(f"'{SEED}|' || key || '|' || shard")} % greatest(s // {BLOCK_TOKENS}, 1) * {BLOCK_TOKENS} AS start
  FROM given),
placed AS (
  SELECT r.*, q.*, coalesce(quota // nullif(s, 0), 0)::BIGINT AS rounds,
         (sum(size) OVER (PARTITION BY r.key, q.shard ORDER BY draw, doc_id, size ROWS UNBOUNDED PRECEDING))::BIGINT AS stop
  FROM rows r JOIN quotas q ON r.key = q.key AND r.draw % {SHARDS} = q.shard),
bound AS (SELECT *, start + quota - rounds * s AS upto, stop - size AS begin FROM placed)
SELECT doc_id, size, source_size, target,
       (rounds * size + greatest(least(stop, upto) - greatest(begin, start), 0)
        + greatest(least(stop, upto - s) - greatest(begin, 0), 0))::BIGINT AS taken
FROM bound"""
