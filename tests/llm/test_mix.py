from collections import defaultdict

import pytest

from tests.llm import brute
from tests.llm.conftest import ODD, rows_of
from twinview.llm import mix

COLUMNS = ("doc.doc_id", "size", "source_size", "target", "taken", "copies")


def shares(sizes, weights=(5, 2, 1), most=3):
    """Targets by sharing again and again what is over the bounds."""
    total, out, left = sum(sizes.values()), {}, sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(left)}
    while left:
        rest, whole = total - sum(out.values()), sum(weight[s] for s in left)
        over = [s for s in left if rest * weight[s] / whole > most * sizes[s]]
        if not over:
            return out | {s: rest * weight[s] / whole for s in left}
        out |= {s: most * sizes[s] for s in over}
        left = [s for s in left if s not in over]
    return out


def check(df, rows, tolerance, **options):
    found = mix.mix(df, **options).selectExpr("doc.source", *COLUMNS).collect()
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += len(brute.words(text))
    expected, taken = shares(sizes), defaultdict(int)
    for r in found:
        assert r["source_size"] == sizes[r["source"]] and r.target == pytest.approx(expected[r["source"]], abs=1e-6)
        assert 0 <= r.taken <= 3 * r["size"] and 0 <= r.copies <= 3
        taken[r["source"]] += r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= tolerance(target)
    assert sorted(r.doc_id for r in found) == sorted(d for d, _, _ in rows)
    return found


def test_a_source_comes_near_its_target(documents):
    rows = [(r.doc_id, r.text, r.source) for r in documents.collect()]
    check(documents, rows, lambda target: max(8, 0.02 * target))
    check(documents, rows, lambda target: 1, block_tokens=1, shards=1)


def test_reruns_agree_whatever_the_partitions(documents):
    first = rows_of(mix.mix(documents), *COLUMNS)
    assert rows_of(mix.mix(documents.repartition(7)), *COLUMNS) == first


def test_odd_rows(odd, empty):
    rows = [*ODD, ODD[0], ODD[2], ODD[8]]
    check(odd, rows, lambda target: 4 * len(rows), block_tokens=4)
    assert rows_of(mix.mix(odd), "doc.size", "doc._key") == [("own size", "own _key")] * len(rows)
    assert mix.mix(empty).count() == 0


def test_texts_without_words_are_not_taken(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, "", None), (3, " \n", "b")], "doc_id long, text string, source string")
    assert rows_of(mix.mix(df), "doc.doc_id", "size", "target", "taken", "copies") == [(1, 0, 0, 0, 0), (2, 0, 0, 0, 0), (3, 0, 0, 0, 0)]


@pytest.mark.parametrize("seats", [0, 1, 7, 100, 12345])
def test_blocks_go_by_highest_quotient(spark, seats):
    votes = {"a": 5300, "b": 2400, "c": 2400, "d": 17, "e": 0, "f": 1}
    parties = spark.createDataFrame([(0, p, v, seats, sum(votes.values())) for p, v in votes.items()], "g int, p string, v long, s long, w long")
    found = {r.p: r.blocks for r in mix._apportioned(parties, ["g"], "s", "v", "w", ["p"]).collect()}
    expected = dict.fromkeys(votes, 0)
    for _ in range(seats):
        best = max(sorted(votes), key=lambda p: votes[p] / (2 * expected[p] + 1))
        expected[best] += 1
    assert found == expected


def test_no_python_in_the_plan(documents):
    plan = mix.mix(documents)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"))


@pytest.mark.parametrize("words", [1, 2, 4, 10])
@pytest.mark.parametrize("bound", [3, 1])
def test_a_source_of_short_texts_reaches_its_target(spark, words, bound):
    """At its bound to the word, and below it within a block of each kind."""
    rows = [(i, " ".join("w" * words), "a small") for i in range(1500)]
    rows += [(10_000 + i, "w " * 200, "b large") for i in range(10 * words * (20 if bound == 3 else 1))]
    found = mix.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).selectExpr("doc.source", "size", "target", "taken", "copies").collect()
    taken, target = defaultdict(int), {}
    for r in found:
        assert 0 <= r.taken <= 3 * r["size"]
        taken[r["source"]] += r.taken
        target[r["source"]] = r.target
    assert target["a small"] == 3 * 1500 * words or bound == 1
    for source, wanted in target.items():
        assert abs(taken[source] - wanted) <= 8, (source, taken[source], wanted)
    assert sum(taken.values()) == pytest.approx(sum(r["size"] for r in found), abs=16)


def test_the_rest_stays_within_its_room(spark):
    """Shares of a source that is all cut: the whole room, and no shard above its own."""
    rooms = {f"p{i:02}": i % 4 for i in range(60)}
    for rest in (0, 1, 17, sum(rooms.values()) - 1, sum(rooms.values())):
        parties = spark.createDataFrame([(0, p, v, rest, sum(rooms.values())) for p, v in rooms.items()], "g int, p string, v long, s long, w long")
        found = {r.p: r.blocks for r in mix._apportioned(parties, ["g"], "s", "v", "w", ["p"]).collect()}
        assert sum(found.values()) == rest and all(found[p] <= rooms[p] for p in rooms)
