import itertools
import random
import zlib

import numpy as np
import pytest

from tests.llm.conftest import rows_of
from twinview.llm import toxicity

SF01 = "/root/testdata/sf0.1"


@pytest.fixture(scope="module")
def channel(spark):
    return toxicity.fit_channel(spark.read.parquet(f"{SF01}/documents.parquet"))


@pytest.mark.parametrize(("token", "word"), [
    ("l0ser", "loser"), ("1d10t", "idiot"), ("stuuupid", "stupid"), ("s.t.u.p.i.d", "stupid"), ("m0r0n,", "moron"),
    ("tr@sh", "trash"), ("p4thet1c", "pathetic"), ("$cum", "scum"), ("cl0wn", "clown"), ("D1SGU5TING", "disgusting"),
    ("id!ot", "idiot"), ("loser!!!", "loser"), ("the&&&", "the"), ("45.114.23.72", "45.114.23.72"), ("Plain,", "plain"),
    ("été", "été"), ("", ""), ("%%%", ""),
])
def test_tokens_are_restored(channel, token, word):
    assert toxicity._token_words(token, channel) == word


def test_spaced_words_are_restored(channel):
    from twinview.llm.arrow import texts_of, words_of
    import pyarrow as pa

    texts = texts_of(pa.array(["you are s t u p i d they say", "a a a a a a a", None, "1 2 3"], pa.string()))
    _, _, spaced = toxicity._restored(texts, words_of(texts), channel)
    assert (0, 2, "stupid") in spaced and all(t == 0 for t, _, _ in spaced)


def lattice(token):
    """For each sign, or gap of spaces, what it may be: (letters, code or None, cost)."""
    signs, out, before = toxicity._GAPS.findall(token), [], ""
    narrow = min((len(s) for s in signs if s[0] == " "), default=0)
    for sign in signs:
        if sign[0] == " ":
            out.append([(" ", toxicity._BOUND, 0.0), ("", None, toxicity.LEFT_OUT * (len(sign) - narrow))])
            continue
        written = toxicity.LEET.get(sign, "")
        options = [(sign, int(toxicity._CODES[ord(sign)]), toxicity.SAME)]
        options += [(c, int(toxicity._CODES[ord(c)]), toxicity.WRITTEN - float(np.log(len(written)))) for c in written]
        if sign in toxicity.SEPARATORS:
            options.append(("", None, toxicity.LEFT_OUT))
        elif sign == before:
            options.append(("", None, toxicity.SAME))
        out.append(options)
        before = sign
    return out


def values_of(channel, token):
    """The value of the best path to each text that a token may stand for, by every path of its lattice."""
    found = {}
    for path in itertools.product(*lattice(token)):
        value, a, b = 0.0, toxicity._BOUND, toxicity._BOUND
        for code, price in [*((code, price) for _, code, price in path), (toxicity._BOUND, 0.0)]:
            value += price
            if code is not None:
                value += float(channel.log[a, b, code])
                a, b = b, code
        text = "".join(letters for letters, _, _ in path)
        found[text] = max(found.get(text, -np.inf), value)
    return found


def test_decoding_finds_the_best_of_all_paths(channel):
    rng = random.Random(5)
    tokens = ["".join(rng.choice("abeiostux  ..--_*@$!|+(013457é#中") for _ in range(rng.randrange(1, 8))).strip() for _ in range(250)]
    tokens += ["s t u p", "s  t u p", "l0ser", "$h!t", "aaab", "a..b", "1d10t", "", "|*|", "b.a.d"]
    for token in tokens:
        values = values_of(channel, token)
        assert values[channel.restore(token)] == pytest.approx(max(values.values()), abs=1e-6), token


def cuts(letters, known):
    """Every way to cut letters into words, those of ``known`` taken as such (True) or spelt."""
    if not letters:
        yield []
    for n in range(1, len(letters) + 1):
        for taken in ([False, True] if letters[:n] in known and n > 2 else [False]):
            for rest in cuts(letters[n:], known):
                yield [(letters[:n], taken), *rest]


def test_known_words_are_those_of_the_best_cut(channel):
    rng, bound = random.Random(6), toxicity._BOUND
    known = {"bad", "adder", "idiot", "you", "the", "ab", "eat"}
    rows = ["".join(rng.choice([*known, *"abdeinotuy"]) for _ in range(4))[:11] for _ in range(60)]
    for letters in [*rows, "youidiot", "badder", ""]:
        best = (-np.inf, [])
        for cut in cuts(letters, known):
            value, last = 0.0, bound
            for word, taken in cut:
                codes = [int(toxicity._CODES[ord(c)]) for c in word]
                if taken:
                    value += toxicity.KNOWN
                else:
                    for a, b, c in zip([last, bound, *codes], [bound, *codes], [*codes, bound]):
                        value += float(channel.log[a, b, c])
                last = codes[-1]
            best = max(best, (value, sorted(w for w, taken in cut if taken)), key=lambda x: x[0])
        assert sorted(channel._known_words(letters, known)) == best[1], letters


@pytest.fixture(scope="module")
def scored(spark):
    docs = spark.createDataFrame(toxicity.op8_noisy_channel(spark, SF01).toPandas())
    return docs.join(spark.read.parquet(f"{SF01}/labels.parquet"), "doc_id").toPandas()


def test_held_out_accuracy(scored):
    held = scored[scored.held_out]
    found, true = held.predicted == 1, held.toxic == 1
    assert (found & true).sum() / true.sum() >= 0.9 and (found & true).sum() / found.sum() >= 0.8
    assert ((scored.score >= 0.3) == (scored.predicted == 1)).all() and scored.score.between(0, 1).all()
    assert (scored.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in scored.doc_id]).all()


def test_labels_of_held_out_rows_are_not_used(spark, channel):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    turned = labels.selectExpr("doc_id", "CASE WHEN crc32(encode(string(doc_id), 'UTF-8')) % 4 = 2 THEN 1 - toxic ELSE toxic END AS toxic")
    assert toxicity.learn(docs, turned, channel) == toxicity.learn(docs, labels, channel)


def test_restored_texts_score_like_plain_ones(spark, channel):
    weights = {"stupid": 6.0, "loser": 6.0}
    rows = [(1, "you are a stupid one"), (2, "you are a stup1d one"), (3, "you are a s t u p i d one"), (4, "you are a nice one"), (5, None), (6, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(df, channel, weights, -3.0).collect()}
    assert found[1] == found[2] == found[3] > 0.9 and found[4] == found[5] == found[6] < 0.1


def test_odd_rows(spark, odd, empty, channel):
    scored = toxicity.score(odd, channel, {}, -2.0)
    assert scored.count() == odd.count() and rows_of(scored.select("kept").distinct(), "*") == [("own kept",)]
    assert rows_of(toxicity.score(odd, channel, {}, 0.0, name="doc").select("doc").distinct(), "*") == [(0.5,)]
    assert toxicity.score(empty, channel, {}, -2.0).count() == 0
    nothing = toxicity.fit_channel(empty)
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1), (3, None)], "doc_id long, toxic int")
    weights, bias = toxicity.learn(odd, labels, nothing)
    assert weights == {} and toxicity.score(odd, nothing, weights, bias).count() == odd.count()
    assert toxicity.learn(empty, labels.limit(0), nothing)[0] == {}


SENTENCE = "you are not here and the stupid loser is in the house"


@pytest.mark.parametrize("written", [
    " ".join(SENTENCE.replace(" ", "")),
    "   ".join(" ".join(w) for w in SENTENCE.split()),
    " ".join((SENTENCE * 3).replace(" ", "")),
    ".".join(SENTENCE.replace(" ", "")),
    SENTENCE.replace(" ", "..."),
    "they say: " + " ".join("y0uar3astup1d1ose"),
    "s" + "t" * 70 + "u" * 70 + "pid",
    "s.t.u.p." + "-" * 70 + "i.d",
])
def test_long_and_spaced_texts_are_restored(spark, channel, written):
    weights = {"stupid": 6.0, "loser": 6.0}
    df = spark.createDataFrame([(1, written), (2, " ".join("wearehereandthereisnothingtoseeinthehouseofthem"))], "doc_id long, text string")
    found = {r.doc_id: r.score for r in toxicity.score(df, channel, weights, -3.0).collect()}
    assert found[1] > 0.9 and found[2] < 0.1


def test_words_of_a_row(channel):
    assert channel.restore("t h e h o u s e").replace(" ", "") == "thehouse"
    assert {"stupid", "loser"} <= set(channel.row_words(" ".join("youareastupidloser"), {"stupid", "loser"}))
    # a known word inside a likelier one is none
    assert "her" not in channel.row_words(" ".join("thereisanother"), {"her"})
    assert "rubbish" in channel.row_words(" ".join("thisisrubbishandnonsense"), {"rubbish"})
    # no length is too long
    assert channel.row_words(" ".join("stupid" * 2000), {"stupid"}).count("stupid") == 2000
