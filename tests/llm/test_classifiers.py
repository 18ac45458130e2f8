import zlib

import numpy as np
import pytest

from pyspark.sql import functions as F

from marketlane.llm import quality, toxicity
from marketlane.llm.common import table
from tests.llm.frames import ODD, documents

MIDDLE = "/root/testdata/sf0.01"
LARGE = "/root/testdata/sf0.1"


def agreement(rows, labels):
    known = [(r["predicted"], labels[r["doc_id"]], r["score"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return float(np.mean([p == l for p, l, _ in known])), known


def check(rows, modulus, remainder, n):
    assert len(rows) == n
    for r in rows:
        text = "" if r["doc_id"] is None else str(r["doc_id"])
        assert r["held_out"] == (zlib.crc32(text.encode()) % modulus == remainder)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)


@pytest.fixture(scope="module")
def middle(spark):
    docs, labels = table(spark, MIDDLE, "documents"), table(spark, MIDDLE, "labels")
    return docs, labels, labels.collect()


def test_toxicity_holds_on_held_out_rows(middle):
    docs, labels, known = middle
    rows = toxicity.toxicity_scores(docs, labels).collect()
    check(rows, 5, 0, docs.count())
    share, pairs = agreement(rows, {r["doc_id"]: r["toxic"] for r in known})
    assert share >= 0.9
    mean = lambda label: np.mean([s for _, l, s in pairs if l == label])
    assert mean(1) > mean(0) + 0.3


def test_toxicity_recall_in_every_language(spark):
    """The fixed list is English; held-out toxic rows of the other languages hold none of its words."""
    docs, labels = table(spark, LARGE, "documents"), table(spark, LARGE, "labels")
    toxic = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    got = {}
    for r in toxicity.toxicity_scores(docs, labels).where("held_out").collect():
        if toxic.get(r["doc_id"]) in (0, 1):
            got.setdefault((lang[r["doc_id"]], toxic[r["doc_id"]]), []).append(r["predicted"])
    print({k: (sum(v), len(v)) for k, v in sorted(got.items())})
    for code in ("en", "fr", "de", "es"):
        assert np.mean(got[code, 1]) >= 0.6, code
        assert np.mean(got[code, 0]) <= 0.05, code


def test_lexicon_learns_from_growing_rows_only(spark):
    part = {k: zlib.crc32(str(k).encode()) % 5 for k in range(1, 600)}
    words = {k: f"grown wort{k % 7}" if part[k] > 1 else "calibrated" if part[k] else "heldout" for k in part}
    docs = documents(spark, [(k, f"{words[k]}, plain text." if k % 3 == 0 else "Only plain text.") for k in part])
    labels = spark.createDataFrame([(k, int(k % 3 == 0)) for k in part], "doc_id long, toxic int")
    learnt = toxicity.lexicon(docs, labels)
    assert {"grown", "^grown"} <= set(learnt) and not {"calibrated", "heldout", "plain", "text"} & set(learnt)
    assert len(learnt["grown"]) == 4 and all(w > 0 for w in learnt["grown"])
    counts = {r["token"]: r for r in toxicity.token_counts(docs, labels).collect()}
    grow = [k for k in part if part[k] > 1]
    assert sum(counts[""][f"n{f}"] for f in toxicity.GROWING) == len(grow)
    assert sum(counts["grown"][f"p{f}"] for f in toxicity.GROWING) == sum(k % 3 == 0 for k in grow)
    assert toxicity.lexicon(docs, labels.limit(0)) == {}


def test_quality_holds_on_held_out_rows(middle):
    docs, labels, known = middle
    rows = quality.quality_scores(docs, labels).collect()
    check(rows, 3, 1, docs.count())
    share, _ = agreement(rows, {r["doc_id"]: r["quality"] for r in known})
    assert share >= 0.9


@pytest.mark.parametrize("scores,modulus,remainder,column", [(toxicity.toxicity_scores, 5, 0, "toxic"), (quality.quality_scores, 3, 1, "quality")])
def test_odd_rows(spark, scores, modulus, remainder, column):
    docs = documents(spark, ODD)
    kind = f"doc_id long, {column} int, score double"
    some = spark.createDataFrame([(k, k % 2, 1.0) for k in range(1, 9)] + [(4, 1, 1.0), (None, 1, 1.0), (6, None, 1.0), (99, 1, 1.0), (2, 7, 1.0)], kind)
    check(scores(docs, some).collect(), modulus, remainder, len(ODD))
    assert {r["score"] for r in scores(docs, some.limit(0)).collect()} == {0.0}
    one_sided = spark.createDataFrame([(k, 1, 1.0) for k in range(1, 9)], kind)
    check(scores(docs, one_sided).collect(), modulus, remainder, len(ODD))
    assert scores(docs.limit(0), some).count() == 0


def test_rejected_documents_go_and_columns_stay(spark):
    good = [(k, f"Plain words in a row make text number {k} of the good kind, with commas.") for k in range(0, 60, 2)]
    bad = [(k, f"$$$ %%% @@@ ### junk{k} $$$ %%% ||| ### @@@ $$$ %%%") for k in range(1, 60, 2)]
    docs = documents(spark, good + bad)
    labels = spark.createDataFrame([(i, int(i % 2 == 0)) for i, _ in good + bad], "doc_id long, quality int")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [i for i, _ in good]
    assert quality.keep_good(docs, labels.limit(0)).count() == 60


def test_votes_equal_a_plain_search():
    rng = np.random.default_rng(8)
    train, labels = quality.unit(rng.standard_normal((40, 6))), rng.integers(0, 2, 40).astype(float)
    asked = quality.unit(rng.standard_normal((15, 6)))
    for row, got in zip(asked, quality.vote(asked @ train.T, labels, 5)):
        near = sorted(range(40), key=lambda k: -float(row @ train[k]))[:5]
        weight = [max(0.0, float(row @ train[k])) ** quality.SHARPNESS for k in near]
        assert got == pytest.approx(sum(w * labels[k] for w, k in zip(weight, near)) / sum(weight), rel=1e-3)


def test_isotonic_points_rise_and_keep_the_total():
    rng = np.random.default_rng(9)
    scores, weights = np.sort(rng.random(50)), rng.integers(1, 9, 50).astype(float)
    positives = np.minimum(weights, rng.integers(0, 9, 50)).astype(float)
    points = toxicity.isotonic(scores, weights, positives)
    rates = [r for _, r in points]
    assert rates == sorted(rates)
    fitted = np.interp(scores, *zip(*points))
    assert (weights * fitted).sum() == pytest.approx(positives.sum())


def test_disguised_words_are_found():
    assert toxicity.word_class(b"Idiot!") == 1 and toxicity.word_class(b"1d10t") == 17 and toxicity.word_class(b"i.d.i.o.t") == 17
    assert toxicity.word_class(b"you,") == 8 and toxicity.word_class(b"table") == 0 and toxicity.word_class(b"losers") == 1


def plain_features(text, learnt, column):
    """Word by word and byte by byte, as the docstrings say."""
    words = text.split()
    n, size = max(1, len(words)), max(1, len(text))
    kinds = [toxicity.word_class(w) for w in words]
    lexicon = [k for k, c in enumerate(kinds) if c & 7]
    you = [k for k, c in enumerate(kinds) if c & 8]
    near = sum(any(abs(k - y) <= toxicity.NEAR for y in you) for k in lexicon)
    among = lambda chars: sum(b in chars for b in text)
    capitals, small = among(range(65, 91)), among(range(97, 123))
    share = lambda bit: sum(1 for c in kinds if c & bit) / n
    upper = sum(len(w) > 2 and w.isupper() for w in words)
    out = [share(1), share(2), share(4), len(lexicon) / n, min(len(lexicon), 50), float(bool(lexicon)), near / n, len(you) / n]
    out += [capitals / max(1, capitals + small), upper / n, among(b".,;:'\"()-?") / size, among(b"!") / size, share(16)]
    out += [among(b"#$%&*+/<=>@[\\]^_`{|}~") / size, among(range(48, 58)) / size, float(np.log1p(len(words)))]
    weight = lambda w: max((learnt[t][column] for t in toxicity.tokens(toxicity.plain_word(w)) if t in learnt), default=0.0)
    held = {w: weight(w) for w in words if weight(w) > 0}
    count = sum(w in held for w in words)
    return out + ([count / n, min(count, 50), min(len(held), 50), max(held.values())] if held else [0.0] * 4)


def test_features_equal_a_plain_count(spark, small):
    docs = [tuple(r) for r in table(spark, small, "documents").select("doc_id", "text").collect()]
    docs += [(10_001, "you IDIOT, you i.d.i.o.t and LOSERS!!! kill kill #$%@ [x] ~"), *[(20_000 + k, t) for k, (_, t) in enumerate(ODD)]]
    learnt = {"the": (1.0, 0.5, 0.0, 2.0), "^idiot": (0.7, 0.0, 0.1, 0.2), "und": (0.0, 0.4, 0.0, 0.0), "kill": (3.0, 1.0, 2.0, 0.0)}
    got = {r["doc_id"]: r for r in toxicity.features(documents(spark, docs), learnt).collect()}
    for i, text in docs:
        whole, part = (text or "").encode(), zlib.crc32(str(i).encode()) % 5
        assert got[i]["x"] == pytest.approx(plain_features(whole, learnt, 0), abs=1e-12)
        column = 1 + toxicity.GROWING.index(part) if part in toxicity.GROWING else 0
        assert got[i]["own"] == pytest.approx(plain_features(whole, learnt, column), abs=1e-12)


def test_calibrated_scores_follow_the_points(spark):
    points = [(0.0, 0.1), (1.0, 0.1), (2.0, 0.6), (4.0, 1.0)]
    raw = [-3.0, 0.0, 0.5, 1.5, 2.0, 3.3, 9.0]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in raw], "raw double").select(toxicity.calibrated(F.col("raw"), points)).collect()]
    assert got == pytest.approx(np.interp(raw, *zip(*points)))
