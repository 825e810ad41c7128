"""Toxicity as ordered severity grades: a cumulative-link model shares one weight per word
across all thresholds between grades.

    P(grade <= k) = 1 / (1 + exp(score - threshold_k))

The score is the sum of weight * log2(1 + count) over the features of a text: its lower-case
words and their first letters, which catch the endings that a word takes.
"""

import math
from array import array
from collections import Counter

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketpulse.llm.common import documents, small

WORD = r"[^\s\p{P}\p{S}]+"  # runs without white space, punctuation or symbols
PREFIXES = (5, 7)  # letters of a word that are a feature of their own
SCORES = "doc_id long, score double, severity double, grade int, toxic boolean"


def words_of(text, pattern):
    """Occurrences of each lower-case word."""
    return Counter(pattern.findall(text.lower()))


def with_prefixes(words):
    """The words' counts and, marked by a `^`, those of the beginnings of longer words."""
    found = Counter(words)
    for word, n in words.items():
        for length in PREFIXES:
            if len(word) >= length:
                found["^" + word[:length]] += n
    return found


def severity_grades(labels):
    """doc_id and grade from the two labels: 0 not toxic, 1 toxic, 2 toxic and of poor
    quality. Labels of one document that disagree give the highest grade; a null label
    counts as not toxic, a null quality as good."""
    grade = F.when(F.coalesce("toxic", F.lit(0)) != 1, 0).when(F.coalesce("quality", F.lit(1)) == 1, 1).otherwise(2)
    return (
        labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(grade).cast("int").alias("grade"))
    )


def training_sample(docs, grades, rows_per_grade=1500):
    """At most `rows_per_grade` labelled documents of each grade, the ones with the smallest
    hashes of doc_id, as (doc_id, grade, text). Of several rows of one id the text with the
    smallest hash is taken; each task sends one row per id. The bound keeps what is broadcast
    and what the driver fits small; it is the only place where not every document is read."""
    by_hash = F.xxhash64("doc_id")
    picked = [
        grades.where(F.col("grade") == g).orderBy(by_hash, "doc_id").limit(rows_per_grade) for g in range(3)
    ]
    picked = picked[0].unionAll(picked[1]).unionAll(picked[2])
    rows = documents(docs).join(F.broadcast(picked), "doc_id").select("doc_id", "grade", "text")
    first = Window.partitionBy("doc_id").orderBy(F.xxhash64("text"), "text")
    return rows.withColumn("place", F.row_number().over(first)).where("place = 1").drop("place")


class OrdinalModel:
    """Weights by feature and increasing thresholds between the grades."""

    def __init__(self, weights, thresholds):
        self.weights, self.thresholds = weights, thresholds
        self.prefixes = sorted({len(f) - 1 for f in weights if f[0] == "^"})

    def score(self, words):
        """Of a Counter of words; only words that carry a weight are looked at closer."""
        weights, found = self.weights, Counter()
        for word, n in words.items():
            if word in weights:
                found[word] += n
            for length in self.prefixes:
                if len(word) >= length and (start := "^" + word[:length]) in weights:
                    found[start] += n
        return sum(weights[f] * math.log2(1 + n) for f, n in sorted(found.items()))

    def above(self, score):
        """P(grade > k) for each threshold k, falling."""
        return 1.0 / (1.0 + np.exp(np.clip(np.asarray(self.thresholds) - score, -60, 60)))


def ordered(cuts, gap=0.05):
    """Thresholds in rising order, at least `gap` apart."""
    steps = gap * np.arange(len(cuts))
    return np.maximum.accumulate(cuts - steps) + steps


def fit_ordinal(samples, grades=3, totals=None, least_documents=3, shrink=0.5, rounds=300, rate=0.5):
    """An OrdinalModel from (grade, Counter of features) pairs.

    Accelerated proximal gradient on the negative log likelihood of the grades. `totals`
    gives the number of labelled documents by grade where `samples` are only some of them;
    each sample then weighs as many as it stands for. `shrink` is the L1 penalty in
    documents: a feature must explain more than that many to get a weight. Features of fewer
    than `least_documents` samples are left out. Without samples of a higher grade the model
    calls nothing toxic.
    """
    index, ids, values, lengths, y = {}, array("l"), array("d"), [], []
    for grade, found in samples:
        y.append(grade)
        lengths.append(len(found))
        for feature, c in sorted(found.items()):
            ids.append(index.setdefault(feature, len(index)))
            values.append(math.log2(1 + c))
    y, n = np.array(y, dtype=np.int64), len(y)
    if not n or y.max() == 0 or y.min() > 0:
        return OrdinalModel({}, [30.0 + k for k in range(grades - 1)])
    drawn = np.bincount(y, minlength=grades)
    stands = np.array([(totals or {}).get(k, int(drawn[k])) for k in range(grades)]) / np.maximum(drawn, 1)
    weight = stands[y] * n / stands[y].sum()

    ids, doc = np.frombuffer(ids, dtype=f"i{ids.itemsize}"), np.repeat(np.arange(n), lengths)
    enough = np.bincount(ids, minlength=len(index)) >= least_documents
    place = np.cumsum(enough) - 1
    names = [f for f, keep in zip(index, enough) if keep]
    kept = enough[ids]
    word, doc, value = place[ids[kept]], doc[kept], np.frombuffer(values)[kept]

    share = np.array([weight[y > k].sum() / n for k in range(grades - 1)]).clip(1e-4, 1 - 1e-4)
    cuts = ordered(-np.log(share / (1 - share)))

    def gradient(w, t):
        s = np.bincount(doc, weights=w[word] * value, minlength=n)
        below = 1 / (1 + np.exp(np.clip(s[:, None] - t[None, :], -60, 60)))
        cdf = np.hstack([np.zeros((n, 1)), below, np.ones((n, 1))])
        density = np.hstack([np.zeros((n, 1)), below * (1 - below), np.zeros((n, 1))])
        at = np.arange(n)
        p = np.maximum(cdf[at, y + 1] - cdf[at, y], 1e-12)
        upper, lower = weight * density[at, y + 1] / p, weight * density[at, y] / p
        of_score = upper - lower
        of_cuts = np.array([lower[y == k + 1].sum() - upper[y == k].sum() for k in range(grades - 1)])
        return np.bincount(word, weights=of_score[doc] * value, minlength=len(names)), of_cuts

    # A step per feature that the curvature in its documents allows (diagonal preconditioning).
    width = np.sqrt(np.bincount(doc, weights=value * value, minlength=n).clip(1)) * weight
    curvature = np.bincount(word, weights=0.25 * width[doc] * value, minlength=len(names))
    step_w = rate / np.maximum(curvature, 1.0)
    step_t = rate / (0.25 * n)
    w, ahead = np.zeros(len(names)), np.zeros(len(names))
    cuts_ahead, momentum = cuts.copy(), 1.0
    for _ in range(rounds):
        of_w, of_cuts = gradient(ahead, cuts_ahead)
        new = ahead - step_w * of_w
        new = np.sign(new) * np.maximum(np.abs(new) - step_w * shrink, 0.0)
        new_cuts = ordered(cuts_ahead - step_t * of_cuts)
        following = (1 + (1 + 4 * momentum * momentum) ** 0.5) / 2
        back = ((ahead - new) * (new - w)).sum() + ((cuts_ahead - new_cuts) * (new_cuts - cuts)).sum()
        if back > 0:
            following = 1.0  # overshot: start the acceleration anew
        push = max(0.0, (momentum - 1) / following) if following > 1 else 0.0
        ahead, cuts_ahead = new + push * (new - w), ordered(new_cuts + push * (new_cuts - cuts))
        w, cuts, momentum = new, new_cuts, following
    used = np.flatnonzero(w)
    return OrdinalModel({names[i]: float(w[i]) for i in used}, cuts.tolist())


def fit(docs, labels, rows_per_grade=1500, words_per_text=20_000):
    """The model from the bounded sample: executors count the words of each sampled text, and
    the driver fits on at most three times `rows_per_grade` of these counts, each of the
    `words_per_text` most frequent different words of a text at most. A sample weighs as many
    documents as its grade has labels for it."""
    grades = severity_grades(labels)
    totals = {r.grade: r["count"] for r in grades.groupBy("grade").count().collect()}
    sample = training_sample(docs, grades, rows_per_grade)

    def run(batches):
        import pyarrow as pa
        import regex

        pattern = regex.compile(WORD)
        for batch in small(batches):
            found = (words_of(t, pattern) for t in batch.column(2).to_pylist())
            counts = [sorted(sorted(c.items(), key=lambda x: (-x[1], x[0]))[:words_per_text]) for c in found]
            words = pa.array([[w for w, _ in c] for c in counts], pa.list_(pa.string()))
            times = pa.array([[n for _, n in c] for c in counts], pa.list_(pa.int32()))
            yield pa.record_batch([batch.column(0), batch.column(1), words, times], ["doc_id", "grade", "words", "times"])

    counted = sample.mapInArrow(run, "doc_id long, grade int, words array<string>, times array<int>").toArrow()
    counted = counted.sort_by([("doc_id", "ascending")])
    samples = (
        (row["grade"], with_prefixes(dict(zip(row["words"], row["times"]))))
        for batch in counted.to_batches(max_chunksize=64) for row in batch.to_pylist()
    )
    return fit_ordinal(samples, totals=totals)


def toxicity_scores(docs, model, least=0.5):
    """One row per document: doc_id, score, severity, grade, toxic.

    `severity` is the expected grade, the sum of the probabilities to be above each
    threshold; `grade` the number of thresholds that the document is above with at least
    probability `least`; `toxic` a grade of one or more. Null, empty and wordless texts have
    score 0. Every input row gives one row, repeated rows too, and equal texts equal scores;
    an empty table gives none. Whole texts count, one at a time.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        import pyarrow as pa
        import regex

        pattern, known = regex.compile(WORD), shared.value
        for batch in small(batches):
            scores = [known.score(words_of(t, pattern)) for t in batch.column(1).to_pylist()]
            above = [known.above(s) for s in scores]
            grades = [int((p >= least).sum()) for p in above]
            columns = [
                batch.column(0), pa.array(scores, pa.float64()),
                pa.array([round(float(p.sum()), 6) for p in above], pa.float64()),
                pa.array(grades, pa.int32()), pa.array([g > 0 for g in grades], pa.bool_()),
            ]
            yield pa.record_batch(columns, ["doc_id", "score", "severity", "grade", "toxic"])

    return documents(docs).mapInArrow(run, SCORES)


def toxic_documents(docs, labels, rows_per_grade=1500):
    """Scores of all documents by a model fitted on the labelled ones."""
    return toxicity_scores(docs, fit(docs, labels, rows_per_grade))


def without_toxic(docs, model, least=0.5):
    """The rows of `docs` that are not toxic, all columns. The verdict is a column function
    of the whole text alone, so rows are neither joined nor shuffled, equal texts go or stay
    together, null and empty texts have score 0, and an empty table stays empty."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def toxic(texts):
        import pyarrow as pa
        import regex

        pattern, known = regex.compile(WORD), shared.value
        scores = (known.score(words_of(t.as_py(), pattern)) for t in texts)
        return pa.array([bool(known.above(s)[0] >= least) for s in scores], pa.bool_())

    return docs.where(~toxic(F.coalesce(F.col("text"), F.lit(""))))
