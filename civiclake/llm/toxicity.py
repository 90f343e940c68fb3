"""Toxic passages: maximum-scoring segments over token log-odds, calibrated by extreme values.

1. Counts. The words of all documents are the Dirichlet prior; the words of the labelled training
   documents, toxic and clean, are what it is updated with. A word counts once per document, as
   words come in bursts, and also for its prefixes, as inflected forms share a stem.
2. Log-odds. A token's score is the log of its odds in toxic over its odds in clean text, both
   smoothed by the prior; its z-score says how sure that is. Tokens with a small score or z-score
   carry no evidence and cost a little, so that a score has a negative mean in clean text.
3. Segments. One linear scan per text finds all maximal-scoring segments (Ruzzo and Tompa).
4. Calibration. In clean text the best segment of n words exceeds x with probability
   1 - exp(-K n exp(-lambda x)): lambda solves sum p exp(lambda s) = 1, K is the maximum-likelihood
   estimate from clean training documents. The r best segments of a document are aggregated by
   their sum statistic, the smallest p-value over r counts, and a logistic curve turns its
   logarithm into a probability.
"""

from __future__ import annotations

import math
import uuid
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from civiclake.llm.common import alnum_words, map_batches, map_rows

#: Labelled training documents that are used at most, by the order of a hash of their id.
TRAINING_ROWS = 50_000

#: Prefixes of a word that count as tokens, in bytes.
PREFIXES = (4, 5, 6, 8)

#: Weight of the prior, z-score, size of the log-odds and count a token needs, cost of other tokens.
PRIOR_TOKENS = 2_000.0
LEAST_Z = 3.0
LEAST_ODDS = 3.0
LEAST_COUNT = 5
OTHER_TOKEN = -0.05

#: Times that one word counts in ``REPEAT_WINDOW`` words. Positive words that near to each other are of
#: one segment unless clean words stand between, so a word that does not count has counted in its passage.
COUNTED_REPEATS = 2
REPEAT_WINDOW = int(LEAST_ODDS / -OTHER_TOKEN)

#: Words whose scores a worker remembers.
REMEMBERED_WORDS = 200_000

#: Distinct words counted in a task before their counts are sent on.
COUNTED_WORDS = 200_000


class _Remembered:
    """Word scores of the model a worker used last; only one model's are kept, as workers outlive models."""

    def __init__(self) -> None:
        self.mark, self.scores = "", {}

    def scores_of(self, mark: str) -> dict[bytes, float]:
        if mark != self.mark:
            self.mark, self.scores = mark, {}
        return self.scores


_REMEMBERED = _Remembered()


@dataclass
class Model:
    """What scoring needs: token scores, extreme-value parameters, the logistic curve."""

    scores: dict[bytes, float] = field(default_factory=dict)
    rate: float = 1.0
    k: float = 1.0
    slope: float = 0.0
    offset: float = -50.0
    mark: str = field(default_factory=lambda: uuid.uuid4().hex)

    def word_score(self, word: bytes) -> float:
        """The largest score of a word and its prefixes, 0 if none is known."""
        return max((self.scores[t] for t in tokens(word) if t in self.scores), default=0.0)

    def hits(self, words: list[bytes]) -> list[tuple[int, float]]:
        known = _REMEMBERED.scores_of(self.mark)
        distinct = set(words)
        new = distinct.difference(known)
        if len(known) + len(new) > REMEMBERED_WORDS:
            known.clear()
            new = distinct
        known.update((word, self.word_score(word)) for word in new)
        scores = list(map(known.__getitem__, words))
        return [(n, score) for n, score in enumerate(scores) if score]

    def counted_hits(self, words: list[bytes]) -> list[tuple[int, float]]:
        """Hits where a word counts twice in a window at most: what repeats on there is no new evidence."""
        counted: dict[bytes, list[int]] = {}
        kept = []
        for n, score in self.hits(words):
            places = counted.setdefault(words[n], [])
            if len(places) < COUNTED_REPEATS or n - places[-COUNTED_REPEATS] >= REPEAT_WINDOW:
                places.append(n)
                kept.append((n, score))
        return kept

    def segments(self, words: list[bytes], repeats: bool = False) -> list[tuple[int, int, float]]:
        """All maximal-scoring segments (first word, past-last word, score) of a text."""
        return maximal_segments(self.hits(words) if repeats else self.counted_hits(words), OTHER_TOKEN)

    def passages(
        self, words: list[bytes], segments: list[tuple[int, int, float]], limit: float
    ) -> list[tuple[int, int, float]]:
        """The significant ones of ``segments``, carried on to the ends of their passages over all occurrences."""
        significant = [s for s in segments if self.rate * s[2] > limit]
        if not significant:
            return []
        every = self.segments(words, repeats=True)
        found, at = [], 0
        for first, past, score in significant:
            while at < len(every) and every[at][1] <= first:
                at += 1
            while at < len(every) and every[at][0] < past:
                first, past = min(first, every[at][0]), max(past, every[at][1])
                at += 1
            if found and first < found[-1][1]:
                found[-1] = (found[-1][0], max(past, found[-1][1]), max(score, found[-1][2]))
            else:
                found.append((first, past, score))
            at = max(at - 1, 0)
        return found

    def statistic(self, segments: list[tuple[int, int, float]], words: int) -> float:
        """-log of the smallest sum-statistic p-value over the r best segments."""
        if not segments or not words:
            return 0.0
        shift = math.log(self.k * words)
        best, total = 0.0, 0.0
        for r, score in enumerate(sorted((s for _, _, s in segments), reverse=True), 1):
            excess = self.rate * score - shift
            total += excess
            if r == 1:
                best = excess if excess > 30 else -math.log(-math.expm1(-math.exp(min(-excess, 3.0))))
            elif excess <= 0:
                break
            else:
                log_p = -total + (r - 1) * math.log(max(total, 1.0)) - math.lgamma(r + 1) - math.lgamma(r)
                best = max(best, -log_p - math.log(r * (r + 1)))
        return max(best, 0.0)

    def judge(self, words: list[bytes]) -> float:
        """The probability that a document of these words is toxic."""
        return self.judged(words)[0]

    def judged(self, words: list[bytes]) -> tuple[float, list[tuple[int, int, float]]]:
        """That probability and the segments it comes from."""
        segments = self.segments(words)
        return self.probability(self.statistic(segments, len(words))), segments

    def probability(self, statistic: float) -> float:
        x = self.slope * math.log1p(statistic) + self.offset
        return 1 / (1 + math.exp(-x)) if x > -700 else 0.0


def tokens(word: bytes) -> list[bytes]:
    """A word and, marked by a star, its prefixes."""
    return [word, *(word[:n] + b"*" for n in PREFIXES if len(word) >= n)]


def maximal_segments(hits: list[tuple[int, float]], other: float) -> list[tuple[int, int, float]]:
    """Ruzzo and Tompa's linear scan; positions that are not ``hits`` all score ``other`` (below 0).

    Segments start and end at positive scores, so a run of other positions is one negative step.
    """
    total, previous = 0.0, -1
    # candidates: first, past-last, cumulative score before and after; before: last candidate of a smaller one
    kept: list[tuple[int, int, float, float, int]] = []
    for place, score in hits:
        total += other * (place - previous - 1)
        previous = place
        if score <= 0:
            total += score
            continue
        first, past, low, high = place, place + 1, total, total + score
        total = high
        at = len(kept) - 1
        while True:
            while at >= 0 and kept[at][2] >= low:
                at = kept[at][4]
            if at < 0 or kept[at][3] >= high:
                break
            first, low = kept[at][0], kept[at][2]
            del kept[at:]
            at = len(kept) - 1
        kept.append((first, past, low, high, at))
    return [(first, past, high - low) for first, past, low, high, _ in kept]


def training_labels(labels: DataFrame, least_rows: int = TRAINING_ROWS) -> DataFrame:
    """(doc_id, toxic) of labelled rows whose crc32(doc_id as text) mod 3 is not 1, one row per id, bounded."""
    train = (
        labels.where("doc_id IS NOT NULL AND toxic IN (0, 1) AND crc32(CAST(doc_id AS STRING)) % 3 != 1")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    return train.orderBy(F.xxhash64("doc_id"), "doc_id").limit(least_rows)


def word_counts(documents: DataFrame, known: dict[int, int]) -> DataFrame:
    """(token, n_all, n_toxic, n_clean), documents each; ``known`` has the training labels."""
    shared = documents.sparkSession.sparkContext.broadcast(known)

    def run(rows):
        label_of = shared.value
        counts: tuple[Counter, Counter, Counter] = (Counter(), Counter(), Counter())

        def drained():
            all_words, toxic, clean = counts
            for word, n in all_words.items():
                yield word, n, toxic.get(word, 0), clean.get(word, 0)
            for part in counts:
                part.clear()

        for key, text in rows:
            words = alnum_words(text)
            present = set(words)
            counts[0].update(present)
            if (label := label_of.get(key)) is not None:
                counts[1 if label else 2].update(present)
            if len(counts[0]) >= COUNTED_WORDS:
                yield from drained()
        yield from drained()

    partial = map_rows(documents.select("doc_id", "text"), run, "word binary, n_all bigint, n_toxic bigint, n_clean bigint")
    sums = [F.sum(c).alias(c) for c in ("n_all", "n_toxic", "n_clean")]
    words = partial.groupBy("word").agg(*sums)
    star = F.lit(b"*")
    options = [F.col("word")] + [
        F.when(F.octet_length("word") >= n, F.concat(F.substring("word", 1, n), star)) for n in PREFIXES
    ]
    spread = words.select(F.explode(F.array(*options)).alias("token"), "n_all", "n_toxic", "n_clean")
    return spread.where("token IS NOT NULL").groupBy("token").agg(*sums)


def fit(documents: DataFrame, labels: DataFrame) -> Model:
    """A model from all documents' word counts and at most ``TRAINING_ROWS`` labelled training rows.

    What reaches the driver is bounded by the training rows: their labels, the tokens that ``LEAST_COUNT`` of them
    have, and one number for each.
    """
    train = {r.doc_id: r.toxic for r in training_labels(labels).collect()}
    if len(set(train.values())) < 2:
        return Model()
    from civiclake.plans.scratch import written

    counted = written(word_counts(documents, train), "token-counts")
    totals = counted.where(~F.endswith("token", F.lit(b"*"))).agg(
        F.sum("n_all").alias("a"), F.sum("n_toxic").alias("t"), F.sum("n_clean").alias("c")
    ).first()
    if not totals.t or not totals.c:
        return Model()
    prior = F.col("n_all") * F.lit(PRIOR_TOKENS / totals.a)
    toxic, clean = F.col("n_toxic") + prior, F.col("n_clean") + prior
    all_toxic, all_clean = totals.t + PRIOR_TOKENS, totals.c + PRIOR_TOKENS
    odds = F.log(toxic / (all_toxic - toxic)) - F.log(clean / (all_clean - clean))
    scored = counted.select("token", "n_toxic", "n_clean", odds.alias("score"), (odds / F.sqrt(1 / toxic + 1 / clean)).alias("z"))
    chosen = (
        scored.where((F.abs("z") >= LEAST_Z) & (F.abs("score") >= LEAST_ODDS) & (F.greatest("n_toxic", "n_clean") >= LEAST_COUNT))
        .collect()
    )
    model = Model(scores={bytes(r.token): r.score for r in chosen})
    if not chosen:
        return model
    _calibrate(model, documents, train, labels.schema["doc_id"].dataType.simpleString())
    return model


def _calibrate(model: Model, documents: DataFrame, train: dict[int, int], id_type: str) -> None:
    """Rate, scale and logistic curve of the model, from all segments and hits of the whole training texts.

    Of rows that repeat an id the one with the fewest words counts, then the one of the least segments. Each text is
    searched once and what is found is written; Spark sums it up.
    """
    from civiclake.plans.scratch import written

    spark = documents.sparkSession
    shared = spark.sparkContext.broadcast(model)
    labels = spark.createDataFrame(list(train.items()), f"doc_id {id_type}, toxic int")
    # at most TRAINING_ROWS rows on the right
    labelled = documents.select("doc_id", "text").join(F.broadcast(labels), "doc_id").select("doc_id", "text", "toxic")
    id_type = labelled.schema["doc_id"].dataType.simpleString()

    def run(rows):
        own = shared.value
        for key, text, toxic in rows:
            words = alnum_words(text)
            found = sorted((s for _, _, s in own.segments(words)), reverse=True)
            yield key, toxic, len(words), found, [round(s, 3) for _, s in own.counted_hits(words)]

    schema = f"doc_id {id_type}, toxic int, words bigint, found array<double>, hits array<double>"
    each = map_rows(labelled, run, schema).groupBy("doc_id").agg(F.min(F.struct("words", "found", "hits", "toxic")).alias("row"))
    rows = written(each.select("row.*"), "training-texts")
    clean = rows.where("toxic = 0 AND words > 0")
    longest = F.coalesce(F.array_max("found"), F.lit(0.0))
    texts, words = clean.agg(F.count(F.lit(1)), F.sum("words")).first()
    if not texts or rows.where("toxic = 1 OR words = 0").isEmpty():
        return
    # scores of tokens, to three digits
    histogram = dict(clean.select(F.explode("hits").alias("hit")).groupBy("hit").count().collect())
    values = np.array([OTHER_TOKEN, *histogram])
    shares = np.array([words - sum(histogram.values()), *histogram.values()], float)
    # half an occurrence of the best token, so that a positive score is always possible in clean text
    values, shares = np.append(values, max(model.scores.values())), np.append(shares, 0.5)
    model.rate = _rate(values, shares / shares.sum())
    model.k = texts / clean.agg(F.sum(F.col("words") * F.exp(-model.rate * longest))).first()[0]
    scaled = spark.sparkContext.broadcast(model)

    def judged(rows):
        for toxic, words, found in rows:
            yield toxic, scaled.value.statistic([(0, 0, s) for s in found], words)

    points = map_rows(rows.select("toxic", "words", "found"), judged, "toxic int, statistic double").collect()
    model.slope, model.offset = _logistic(np.array([p.statistic for p in points]), np.array([p.toxic for p in points], float))


def _rate(values: np.ndarray, shares: np.ndarray) -> float:
    """The positive root of sum(shares * exp(rate * values)) = 1, 1 if the mean is not negative."""
    if (values * shares).sum() >= 0:
        return 1.0
    low, high = 0.0, 1e-3
    while (shares * np.exp(high * values)).sum() < 1 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if (shares * np.exp(middle * values)).sum() < 1 else (low, middle)
    return high


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope (0 or more) and offset of a logistic curve over log(1 + x), by Newton steps with a little shrinkage."""
    x = np.log1p(x)
    scale = max(float(np.median(x[y == 1])), 1.0)
    design = np.c_[x / scale, np.ones_like(x)]
    weights = np.zeros(2)
    penalty = np.array([1e-2, 1e-3])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ weights, -30, 30)))
        gradient = design.T @ (p - y) + penalty * weights
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + np.diag(penalty), gradient)
        weights -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-9))
        if np.abs(step).max() < 1e-9:
            break
    return max(float(weights[0]) / scale, 0.0), float(weights[1])


def score(documents: DataFrame, model: Model, with_spans: bool = False, threshold: float = 0.7) -> DataFrame:
    """Per document: doc_id, ``held_out``, ``score``, ``predicted``; ``spans`` of significant passages if asked for.

    A text without words scores like one without toxic segments, so null and empty texts score
    lowest. Repeated rows and null ids pass through (a null id is not held out); only doc_id and
    text are read. Spans are word positions of those segments the score comes from that have an
    expected count below 0.05, together with the words around that only repeat.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(rows):
        own: Model = shared.value
        for key, text in rows:
            words = alnum_words(text)
            value, segments = own.judged(words)
            out = (key, value, int(value >= threshold))
            if with_spans:
                limit = math.log(own.k * max(len(words), 1) / 0.05)
                yield *out, [{"first": a, "past": b, "score": s} for a, b, s in own.passages(words, segments, limit)]
            else:
                yield out

    id_type = documents.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, score double, predicted int"
    if with_spans:
        schema += ", spans array<struct<first: bigint, past: bigint, score: double>>"
    scored = map_rows(documents.select("doc_id", "text"), run, schema)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), *scored.columns[1:])


def keep_clean(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """The rows, with all their columns, that score below ``threshold``; needs a text column only."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    at = documents.columns.index("text")

    def clean(batch: pa.RecordBatch) -> pa.RecordBatch:
        own: Model = shared.value
        return batch.filter(pa.array([own.judge(alnum_words(t.as_py())) < threshold for t in batch.column(at)], pa.bool_()))

    return map_batches(documents, clean)
