"""Toxicity scores: boosted trees over a few dense features, calibrated by isotonic regression.

Beside a fixed English list stands a lexicon learnt from the rows that grow the
trees: words, and stems of a few letters, that far more toxic than clean
documents hold, in whatever language.  The features of a row that grows trees
come from the counts of the other growing folds, so that no row's own label is
among them; all other features come from all of these counts.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from marketlane.llm.common import Memo, fold, slices, texts, written

FOLDS = 5
#: Remainder of the training rows that calibrate; the others grow trees.
CALIBRATION = 1
BINS = 256
#: Remainders of the rows that grow trees and teach the lexicon.
GROWING = [f for f in range(1, FOLDS) if f != CALIBRATION]
#: Toxic documents that a learnt token needs, and how many times their share must be that of clean ones.
MIN_TOXIC = 5
MIN_RATIO = 5.0
#: Learnt tokens that are kept at most, those of most toxic documents first; this bounds what is broadcast.
MAX_TOKENS = 50_000
#: Letters of a stem, which stands for a word's other endings.
STEM = 5

# Common English insults and threats, by strength ("die" is left out: it is a German article).
INSULTS = (
    "clown coward crap creep cretin degenerate dimwit disgusting dumb dumbass dummy failure fool freak garbage"
    " idiot ignorant imbecile jerk liar loser lowlife lunatic maggot miserable moron nasty pathetic pig psycho rat"
    " rubbish scum shameful sicko stupid trash twit ugly useless vermin weirdo worthless wretch"
).split()
PROFANITY = "arse ass asshole bastard bitch bollocks bullshit cunt damn dick douche fuck fucking piss prick shit slut twat wanker whore".split()
THREATS = "beat burn choke crush destroy hang hate hurt kill murder punch shoot slap smash stab strangle suffer".split()
# The reader addressed, in the languages of the corpus.
SECOND_PERSON = "you your yours yourself u ur tu te ti toi ton ta vous votre vos usted ustedes vosotros du dich dir dein deine euch ihr".split()
# Look-alike characters that hide a letter.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""}

FEATURES = (
    "insult_density profanity_density threat_density lexicon_density lexicon_count any_lexicon near_you_density you_density"
    " capital_rate capital_word_rate punctuation_rate exclamation_rate obfuscated_density symbol_rate digit_rate log_words"
    " learnt_density learnt_count learnt_distinct learnt_top"
).split()

NEAR = 5
TRANSLATE = str.maketrans(LOOK_ALIKES)
EDGES = re.compile(r"^\W+|\W+$")


CLASS = {w: 1 for w in INSULTS} | {w: 2 for w in PROFANITY} | {w: 4 for w in THREATS} | {w: 8 for w in SECOND_PERSON}


def _listed(text: str) -> int:
    return CLASS.get(text) or (CLASS.get(text[:-1], 0) if text.endswith("s") else 0)


def word_class(word: bytes) -> int:
    """Bits: 1 insult, 2 profanity, 4 threat, 8 second person, 16 found only without its disguise."""
    plain = word.decode("utf-8", "replace").lower()
    found = _listed(EDGES.sub("", plain))
    if found:
        return found
    found = _listed(plain.translate(TRANSLATE).strip(",;:?\"'()"))
    return found | 16 if found else 0


# Bytes by kind: each count of a kind is what a text loses when these are deleted.
CAPITALS = bytes(range(65, 91))
SMALL = bytes(range(97, 123))
DIGITS = bytes(range(48, 58))
POINTS = b".,;:'\"()-?"
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"

# What is known of a word beside the bits of ``word_class``.
UPPER, LEARNT = 32, 64


def _per_text(bits: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Sums of each text's part of the words of a slice; texts without words have 0."""
    upto = np.concatenate([[0], np.cumsum(bits)])
    return np.diff(upto[np.concatenate([[0], ends])])


def dense_features(batch: list[bytes], kinds: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rates per word or per byte of whole texts, one row each; an empty text has zeros.

    ``kinds`` has the bits of every word of all texts, one text after the other, and ``ends`` where each text's end.
    """
    count = np.diff(np.concatenate([[0], ends]))
    n = np.maximum(1, count)
    has = lambda bit: _per_text((kinds & bit) > 0, ends)
    lexical, addressed = has(7), has(8)
    near = np.zeros(len(batch), dtype=np.int64)
    for t in np.flatnonzero((lexical > 0) & (addressed > 0)):
        own = kinds[ends[t] - count[t] : ends[t]]
        lexicon, you = np.flatnonzero(own & 7), np.flatnonzero(own & 8)
        at = np.searchsorted(you, lexicon)
        after, before = you[np.minimum(at, len(you) - 1)], you[np.maximum(at - 1, 0)]
        near[t] = (np.minimum(np.abs(after - lexicon), np.abs(before - lexicon)) <= NEAR).sum()
    length = np.array([len(t) for t in batch], dtype=np.int64)
    of = lambda chosen: length - np.array([len(t.translate(None, chosen)) for t in batch], dtype=np.int64)
    size, capitals = np.maximum(1, length), of(CAPITALS)
    letters = np.maximum(1, capitals + of(SMALL))
    marks = np.array([t.count(b"!") for t in batch], dtype=np.int64)
    columns = [has(1) / n, has(2) / n, has(4) / n, lexical / n, np.minimum(lexical, 50), lexical > 0, near / n, addressed / n]
    columns += [capitals / letters, has(UPPER) / n, of(POINTS) / size, marks / size, has(16) / n, of(SYMBOLS) / size, of(DIGITS) / size, np.log1p(count)]
    return np.stack([c.astype(np.float64) for c in columns], axis=1)


def plain_word(word: bytes) -> str:
    return EDGES.sub("", word.decode("utf-8", "replace").lower())


def tokens(word: str) -> list[str]:
    """The word itself and, marked, its stem."""
    return [word, "^" + word[:STEM]] if word else []


def token_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``token`` and, per growing fold, its documents and its toxic ones, ``n<fold>, p<fold>``; the empty token counts all documents."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain = Memo(plain_word, 200_000)
        for batch in slices(batches):
            # one string a document, the empty token first: shorter than a list; words hold no newline
            own = ["\n".join(["", *sorted({plain[w] for w in set(t.split())} - {""})]) for t in texts(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(own, pa.string())], names=["doc_id", "words"])

    growing = lambda df: df.where(fold(FOLDS).isin(GROWING))
    rows = growing(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")).mapInArrow(cut, "doc_id long, words string")
    # texts of any number are joined by a sort, whatever the size of the labels, so that disk grows in proportion
    known = labelled(rows.hint("merge"), growing(labels.withColumn("doc_id", F.col("doc_id").cast("long"))), labels.columns[1]).withColumn("words", F.split("words", "\n"))
    stems = F.transform(F.filter("words", lambda w: w != ""), lambda w: F.concat(F.lit("^"), F.substring(w, 1, STEM)))
    each = known.select(fold(FOLDS).alias("fold"), "label", F.explode(F.array_distinct(F.concat("words", stems))).alias("token"))
    sums = [[F.count_if(F.col("fold") == f).alias(f"n{f}"), F.sum(F.when(F.col("fold") == f, F.col("label")).otherwise(0.0)).alias(f"p{f}")] for f in GROWING]
    return each.groupBy("token").agg(*[x for pair in sums for x in pair])


def weight(toxic: float, n: float, all_toxic: float, all_n: float) -> float:
    """How much likelier toxic documents are to hold a token, as a logarithm; 0 for tokens that tell too little."""
    if toxic < MIN_TOXIC or not 0 < all_toxic < all_n:
        return 0.0
    ratio = (toxic / all_toxic) / ((n - toxic + 0.5) / (all_n - all_toxic))
    return math.log(ratio) if ratio >= MIN_RATIO else 0.0


def lexicon(docs: DataFrame, labels: DataFrame) -> dict[str, tuple[float, ...]]:
    """Learnt tokens with their weights: from all growing folds, then from all but each of them."""
    counts = written(token_counts(docs, labels), "toxicity-tokens")
    total = counts.where("token = ''").first()
    if total is None:
        return {}
    toxic, n = (sum((F.col(f"{c}{f}") for f in GROWING), F.lit(0)) for c in "pn")
    all_toxic, all_n = (sum(total[f"{c}{f}"] for f in GROWING) for c in "pn")
    some = counts.where((F.col("token") != "") & (toxic >= MIN_TOXIC))
    # a necessary condition for any of the weights; the exact one follows below
    telling = some.where(toxic * (all_n - all_toxic) * F.lit(len(GROWING)) >= (n - toxic) * all_toxic)
    found = {}
    for r in telling.orderBy(toxic.desc(), n, "token").limit(MAX_TOKENS).collect():
        weights = []
        for left_out in [None, *GROWING]:
            kept = [f for f in GROWING if f != left_out]
            weights.append(weight(*(sum(x[f"{c}{f}"] for f in kept) for x in (r, total) for c in "pn")))
        if any(weights):
            found[r["token"]] = tuple(weights)
    return found


def learnt_features(found: list[tuple[bytes, tuple[float, ...]]], count: int, column: int) -> list[float]:
    """Density, number, distinct words and top weight of the words that the lexicon holds; ``column`` tells whose counts."""
    own = [(w, x[column]) for w, x in found if x[column] > 0]
    if not own:
        return [0.0] * 4
    distinct = dict(own)
    return [len(own) / count, float(min(len(own), 50)), float(min(len(distinct), 50)), max(distinct.values())]


def features(docs: DataFrame, learnt: dict[str, tuple[float, ...]] | None = None) -> DataFrame:
    """``doc_id, x, own``: the dense features of every row's whole text; ``own`` leaves the counts of the row's fold out."""
    shared = docs.sparkSession.sparkContext.broadcast(learnt or {})

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value

        def weigh(word: bytes) -> tuple[float, ...]:
            own = [held[t] for t in tokens(plain_word(word)) if t in held]
            return tuple(map(max, zip(*own)))

        weights = Memo(weigh, 200_000)

        def known(word: bytes) -> int:
            upper = UPPER if len(word) > 2 and word.isupper() else 0
            return word_class(word) | upper | (LEARNT if weights[word] else 0)

        kind_of = Memo(known, 200_000)
        for batch in slices(batches):
            whole = texts(batch)
            words: list[bytes] = []
            ends = np.empty(len(whole), dtype=np.int64)
            for k, text in enumerate(whole):
                words += text.split()
                ends[k] = len(words)
            kinds = np.fromiter(map(kind_of.__getitem__, words), np.int64, len(words))
            dense = dense_features(whole, kinds, ends)
            # words of the lexicon are few: only these are looked at one by one
            found: dict[int, list] = {}
            at = np.flatnonzero(kinds & LEARNT)
            for k, t in zip(at.tolist(), np.searchsorted(ends, at, side="right").tolist()):
                found.setdefault(t, []).append((words[k], weights[words[k]]))
            every, left_out = np.zeros((len(whole), 4)), np.zeros((len(whole), 4))
            folds = batch.column("fold").to_pylist()
            for t, own in found.items():
                count = int(ends[t] - (ends[t - 1] if t else 0))
                every[t] = left_out[t] = learnt_features(own, count, 0)
                if folds[t] in GROWING:
                    left_out[t] = learnt_features(own, count, 1 + GROWING.index(folds[t]))
            offsets = pa.array(np.arange(len(whole) + 1, dtype=np.int32) * len(FEATURES))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.hstack([dense, part]).ravel())) for part in (every, left_out)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *lists], names=["doc_id", "x", "own"])

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", fold(FOLDS).alias("fold"))
    return keyed.mapInArrow(compute, "doc_id long, x array<double>, own array<double>")


def labelled(docs: DataFrame, labels: DataFrame, column: str) -> DataFrame:
    """Rows of ``docs`` that have a label 0 or 1: adds ``label``; several labels of one id count by their largest."""
    own = labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1)).groupBy(F.col("doc_id").cast("long").alias("doc_id"))
    return docs.join(own.agg(F.max(F.col(column)).cast("double").alias("label")), "doc_id")


def isotonic(scores: np.ndarray, weights: np.ndarray, positives: np.ndarray) -> list[tuple[float, float]]:
    """Pool adjacent violators over score bins: (score, rate) points with rising rates."""
    blocks: list[list[float]] = []  # lowest score, highest score, weight, positives
    for s, w, p in sorted(zip(scores.tolist(), weights.tolist(), positives.tolist())):
        blocks.append([s, s, w, p])
        while len(blocks) > 1 and blocks[-2][3] * blocks[-1][2] >= blocks[-1][3] * blocks[-2][2]:
            low, high = blocks[-2], blocks.pop()
            blocks[-1] = [low[0], high[1], low[2] + high[2], low[3] + high[3]]
    points = []
    for low, high, w, p in blocks:
        points += [(low, p / w), (high, p / w)] if high > low else [(low, p / w)]
    return points


def calibrated(raw: Column, points: list[tuple[float, float]]) -> Column:
    """Straight lines between the points, flat beyond them."""
    out = F.lit(points[-1][1])
    for (a, ya), (b, yb) in reversed(list(zip(points, points[1:]))):
        out = F.when(raw <= b, F.lit(ya) + (raw - a) * ((yb - ya) / max(b - a, 1e-12))).otherwise(out)
    return F.when(raw <= points[0][0], F.lit(points[0][1])).otherwise(out)


def toxicity_scores(docs: DataFrame, labels: DataFrame, label: str = "toxic", trees: int = 20, depth: int = 4) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row of ``docs`` (``doc_id, text``).

    Learns from labelled rows whose ``crc32(doc_id) mod 5`` is not 0: remainder 1
    calibrates, the others teach the lexicon and grow the trees; rows with remainder 0 are ``held_out``.
    Missing and empty texts are scored by their zero features.  Labels other than
    0 and 1 and labels without a document are left out; without labels of both
    kinds every score is the share of positive labels, 0 if there are none.
    Repeated rows give equal results; further columns are ignored.
    """
    learnt = lexicon(docs, labels.select("doc_id", label))
    rows = written(features(docs, learnt), "toxicity-features")
    known = written(labelled(rows, labels.select("doc_id", label), label).withColumn("fold", fold(FOLDS)).where("fold <> 0"), "toxicity-train")
    counts = {r["own"]: (r["n"], r["p"]) for r in known.groupBy((F.col("fold") == CALIBRATION).alias("own")).agg(F.count("*").alias("n"), F.sum("label").alias("p")).collect()}
    held = (fold(FOLDS) == 0).alias("held_out")
    n, p = counts.get(False, (0, 0.0))
    if not 0 < p < n:
        total = sum(c[0] for c in counts.values())
        share = sum(c[1] for c in counts.values()) / total if total else 0.0
        return _result(rows.select("doc_id", held, F.lit(float(share)).alias("score")))
    model = GBTClassifier(featuresCol="v", labelCol="label", maxIter=trees, maxDepth=depth, stepSize=0.3, minInstancesPerNode=10, seed=7, cacheNodeIds=False)
    fitted = model.fit(known.where(F.col("fold") != CALIBRATION).select("label", array_to_vector("own").alias("v")))
    raw = vector_to_array(F.col("rawPrediction"))[1]
    apply = lambda df: fitted.transform(df.withColumn("v", array_to_vector("x"))).withColumn("raw", raw)
    n, p = counts.get(True, (0, 0.0))
    calibrating = apply(known.where(F.col("fold") == CALIBRATION) if 0 < p < n else known)
    step = F.round(F.col("raw") * (BINS / 8)) / (BINS / 8)
    bins = calibrating.groupBy(step.alias("s")).agg(F.count("*").alias("w"), F.sum("label").alias("p")).collect()
    points = isotonic(*(np.array([float(r[k]) for r in bins]) for k in ("s", "w", "p")))
    return _result(apply(rows).select("doc_id", held, calibrated(F.col("raw"), points).alias("score")))


def _result(scored: DataFrame) -> DataFrame:
    score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.col("score")))
    return scored.select("doc_id", "held_out", score.alias("score"), (score >= 0.5).cast("int").alias("predicted"))
