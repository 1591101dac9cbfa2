"""Quality classifier learnt from positives and unlabelled text.

The risk is the non-negative unbiased one: with class prior p, positives P and
unlabelled texts U,

    p * E_P[loss(f, 1)] + max(0, E_U[loss(f, 0)] - p * E_P[loss(f, 0)])

U is every row of the table.  With the logistic loss the unbiased risk is
convex, so it goes down by Newton steps, and a step that would take the second
part below zero is shortened until it does not: the model cannot win by
calling trusted texts negative.  f is additive: every measure of a text is cut
into bins at the table's quantiles and each bin has a weight.  The measures of
all texts are written once; a step is one pass over them, in which every task
sums its rows' loss, gradient and second derivatives (the size of the model),
and these are summed by Spark.

The prior is estimated from positives against unlabelled text: of thresholds on
f, the one at which the smallest share of unlabelled texts lies above, for the
share of positives that do, bounds the share of positives among all from above,
tightly where the best texts are all good.  An error in it tilts probabilities
(the order of texts hardly), so where some training rows are labelled 0, the
line a * f + b that fits the labelled training rows best takes f's place.

Labels, language, source and id are no part of the measures.  Of labelled rows
at most ``most_labelled`` of either label are used, chosen by a hash of the id;
everything else covers all rows.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forkcast.llm.words import SPACED, Grams, Words, lower_ascii, runs
from forkcast.session import materialize

#: What is measured of each text; all but the first are shares or means.
MEASURES = ("log_words", "word_bytes", "long_words", "short_words", "distinct_words", "distinct_pairs", "repeated_fives",
            "repeated_eights", "capitals", "capitalised_words", "digits", "not_ascii", "full_stops", "commas", "exclamations",
            "questions", "bars", "symbols", "other_marks", "line_breaks", "commonest_word", "words_a_sentence")


def _measure(data: np.ndarray, off: np.ndarray) -> np.ndarray:
    """A row of MEASURES for each text of a run."""
    n = len(off) - 1
    w = Words(data, off, SPACED)
    words, size = np.maximum(w.counts, 1), np.maximum(np.diff(off), 1)

    def count(wanted):
        total = np.concatenate([[0], np.cumsum(wanted)])
        return total[off[1:]] - total[off[:-1]]

    def of(chars: bytes):
        table = np.zeros(256, bool)
        table[list(chars)] = True
        return count(table[data])

    def repeated(h, row):
        """Sequences beyond the first of their kind, and how often the commonest stands there."""
        order = np.lexsort((h, row))
        h, row = h[order], row[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
        first = np.flatnonzero(new)
        most = np.zeros(n, np.int64)
        np.maximum.at(most, row[first], np.diff(np.append(first, len(h))))
        return np.bincount(row[~new], minlength=n), most

    lengths = w.ends - w.starts
    letters = count(((data | 32) >= 97) & ((data | 32) <= 122))
    capital = (data >= 65) & (data <= 90)
    plain = Words(lower_ascii(data), off, SPACED)
    h = plain.hashes()
    grams = Grams(plain, h)
    again, most = repeated(h, w.row)
    pairs, fives, eights = (repeated(g, w.row[at])[0] for at, g in map(grams.windows, (2, 5, 8)))
    by_word = lambda wanted: np.bincount(w.row[wanted], minlength=n)
    stops = of(b".!?")
    return np.stack([
        np.log1p(w.counts), np.bincount(w.row, lengths, n) / words, by_word(lengths > 14) / words, by_word(lengths < 3) / words,
        1 - again / words, 1 - pairs / words, fives / words, eights / words, count(capital) / np.maximum(letters, 1),
        by_word(capital[w.starts]) / words, of(b"0123456789") / size, count(data >= 128) / size, of(b".") / words, of(b",") / words,
        of(b"!") / words, of(b"?") / words, of(b"|") / words, of(b"#*$%&<>") / words, of(b"\"'()[]{}/\\_=+~^@:;-") / words,
        of(b"\n") / words, most / words, w.counts / np.maximum(stops, 1),
    ], 1).astype(np.float32)


def _measures(batches):
    """mapInArrow: (doc_id, text) -> doc_id, measures."""
    for batch in batches:
        for lo, data, off in runs(batch.column(1)):
            x = _measure(data, off)
            n, k = x.shape
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, n), pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * k), pa.array(x.reshape(-1)))], names=["doc_id", "measures"])


def measures(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, measures (array<float>, in the order of MEASURES)."""
    two = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return two.mapInArrow(_measures, "doc_id long, measures array<float>")


class Model(NamedTuple):
    """Bin edges of each measure, a weight for each bin, an offset, the prior."""

    edges: list[np.ndarray]
    weights: np.ndarray
    offset: float
    prior: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        return self.offset + self.weights[_bins(x, self.edges)].sum(1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x), -50, 50)))

    def calibrated(self, good: np.ndarray, bad: np.ndarray, steps: int = 50) -> Model:
        """The line through f that fits labelled texts best (Newton's method
        on smoothed targets); unchanged if a label has no texts."""
        if not len(good) or not len(bad):
            return self
        f = self.log_odds(np.concatenate([good, bad]))
        target = np.concatenate([np.full(len(good), (len(good) + 1) / (len(good) + 2)), np.full(len(bad), 1 / (len(bad) + 2))])
        x = np.stack([f, np.ones(len(f))], 1)
        line = np.array([1.0, 0.0])
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ line, -50, 50)))
            hessian = (x * (p * (1 - p))[:, None]).T @ x + 1e-3 * np.eye(2)
            line -= np.clip(np.linalg.solve(hessian, x.T @ (p - target) + 1e-3 * (line - [1, 0])), -1, 1)
        if line[0] <= 0:
            return self
        return self._replace(weights=self.weights * line[0], offset=float(self.offset * line[0] + line[1]))


def _bins(x: np.ndarray, edges: list[np.ndarray]) -> np.ndarray:
    """Index of every value's weight."""
    first = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges])])
    return np.stack([first[i] + np.searchsorted(e, x[:, i], side="right") for i, e in enumerate(edges)], 1)


class Pass(NamedTuple):
    """What one pass over unlabelled rows sums up at some weights."""

    n: float
    loss: float
    gradient: np.ndarray
    curvature: np.ndarray


def _width(edges: list[np.ndarray]) -> int:
    return sum(len(e) + 1 for e in edges) + 1


def passed(x: np.ndarray, edges: list[np.ndarray], theta: np.ndarray) -> Pass:
    """Loss of class 0 at each row, summed, with its first and second derivatives
    by the weights (the last one is the offset, which every row has)."""
    size, k = len(theta), x.shape[1]
    index = np.concatenate([_bins(x, edges), np.full((len(x), 1), size - 1)], 1)
    f = theta[index].sum(1)
    p = 1 / (1 + np.exp(-np.clip(f, -50, 50)))
    gradient = np.bincount(index.reshape(-1), np.repeat(p, k + 1), size)
    curvature = np.zeros((size, size))
    first = np.concatenate([[0], np.cumsum([len(e) + 1 for e in edges]), [size]])
    for i in range(k + 1):
        for j in range(i, k + 1):
            high, wide = first[i + 1] - first[i], first[j + 1] - first[j]
            block = np.bincount((index[:, i] - first[i]) * wide + index[:, j] - first[j], p * (1 - p), high * wide).reshape(high, wide)
            curvature[first[i]:first[i + 1], first[j]:first[j + 1]] = block
            curvature[first[j]:first[j + 1], first[i]:first[i + 1]] = block.T
    return Pass(float(len(x)), float(np.logaddexp(0, f).sum()), gradient, curvature)


def penalty(edges: list[np.ndarray], ridge: float, smooth: float) -> np.ndarray:
    """Quadratic form that keeps weights small and neighbouring bins alike."""
    out = np.diag(np.append(np.full(_width(edges) - 1, ridge), 1e-9))
    at = 0
    for e in edges:
        steps = np.diff(np.eye(len(e) + 1), axis=0)
        out[at:at + len(e) + 1, at:at + len(e) + 1] += smooth * steps.T @ steps
        at += len(e) + 1
    return out


def risk(unlabelled: Pass, positive: np.ndarray, edges: list[np.ndarray], theta: np.ndarray, prior: float, held: np.ndarray) -> tuple[float, float]:
    """(unbiased risk with the penalty ``held``, its second part) at some weights."""
    f = theta[-1] + theta[_bins(positive, edges)].sum(1)
    second = unlabelled.loss / unlabelled.n - prior * np.logaddexp(0, f).mean()
    return prior * np.logaddexp(0, -f).mean() + second + theta @ held @ theta / 2, second


def minimise(over, positive: np.ndarray, edges: list[np.ndarray], theta: np.ndarray, prior: float, ridge: float = 3e-3, smooth: float = 0.03,
             steps: int = 15, enough: float = 1e-5) -> np.ndarray:
    """Weights of least risk; ``over(theta)`` is the pass over unlabelled rows.

    A Newton step that takes the risk's second part below zero is replaced by
    the best one that, as far as first derivatives tell, leaves a tenth of it;
    steps are halved while the risk rises or the second part is negative."""
    index = np.concatenate([_bins(positive, edges), np.full((len(positive), 1), len(theta) - 1)], 1)
    mean = lambda weight: np.bincount(index.reshape(-1), np.repeat(weight, index.shape[1]), len(theta)) / len(positive)
    mean_positive = mean(np.ones(len(positive)))
    now = over(theta)
    held = penalty(edges, ridge, smooth)
    value, second = risk(now, positive, edges, theta, prior, held)
    for _ in range(steps):
        gradient = now.gradient / now.n - prior * mean_positive + held @ theta
        curvature = now.curvature / now.n + held
        newton = -np.linalg.solve(curvature, gradient)
        own = now.gradient / now.n - prior * mean(1 / (1 + np.exp(-np.clip(theta[index].sum(1), -50, 50))))  # of the second part
        across = np.linalg.solve(curvature, own)
        along = newton + max(0.1 * second - second - own @ newton, 0.0) / max(own @ across, 1e-12) * across
        best = None
        for step in (newton, along):
            for halved in range(3 if step is newton else 8):
                tried = theta + step / 2 ** halved
                then = over(tried)
                new, left = risk(then, positive, edges, tried, prior, held)
                if new < value and left >= 0:
                    best = tried, then, new, left
                    break
                if step is newton and left < 0:
                    break
            if best:
                break
        if not best:
            break
        gained, (theta, now, value, second) = value - best[2], best
        if gained < enough:
            break
    return theta


def estimated_prior(shares_positive: np.ndarray, shares_unlabelled: np.ndarray) -> float:
    """The least ratio of shares above a threshold, over thresholds that
    half of the positives pass.  Chance makes it rather too small than too
    large, which is the side on which the risk stays away from its bound."""
    ratio = shares_unlabelled / np.maximum(shares_positive, 1e-12)
    return float(np.clip(ratio[shares_positive >= 0.5].min(initial=0.99), 0.01, 0.99))


def _thresholds(positive: np.ndarray, edges: list[np.ndarray], theta: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(thresholds on f, share of positives at or above each)."""
    f = np.sort(theta[-1] + theta[_bins(positive, edges)].sum(1))
    at = np.unique(np.quantile(f, np.linspace(0, 1, 201)))
    return at, 1 - np.searchsorted(f, at) / len(f)


def _above(x: np.ndarray, edges: list[np.ndarray], theta: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many rows lie at or above each threshold."""
    reached = np.searchsorted(at, theta[-1] + theta[_bins(x, edges)].sum(1), side="right")
    return np.bincount(reached, minlength=len(at) + 1)[::-1].cumsum()[::-1][1:]


def learnt(over, above, n: float, positive: np.ndarray, edges: list[np.ndarray], prior: float | None) -> Model:
    """The model of least risk; the prior, unless given, is estimated by a
    first one that takes even shares (the order of texts is hardly the
    prior's)."""
    theta = np.zeros(_width(edges))
    if prior is None:
        # one half of the positives teaches, the other, which it has not seen, is compared
        taught, compared = (positive[::2], positive[1::2]) if len(positive) > 1 else (positive, positive)
        theta = minimise(over, taught, edges, theta, 0.5)
        at, shares = _thresholds(compared, edges, theta)
        prior = estimated_prior(shares, above(theta, at) / n)
    theta = minimise(over, positive, edges, theta, prior)
    return Model(edges, theta[:-1], float(theta[-1]), prior)


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float | None = None, bins: int = 24) -> Model:
    """The same on arrays, in one place."""
    edges = [np.unique(np.quantile(unlabelled[:, i], np.linspace(0, 1, bins + 1)[1:-1])) for i in range(unlabelled.shape[1])]
    over = lambda theta: passed(unlabelled, edges, theta)
    return learnt(over, lambda theta, at: _above(unlabelled, edges, theta, at), len(unlabelled), positive, edges, prior)


def held_out(id_col: str = "doc_id"):
    """Ids whose labels are never learnt from."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 5 == 0, F.lit(False))


def _rows(batch) -> np.ndarray:
    return batch.column("measures").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(MEASURES))


def _summed(measured: DataFrame, edges: list[np.ndarray], theta: np.ndarray) -> Pass:
    """``passed`` over all rows: a row of sums per task and number, summed."""
    size = len(theta)

    def sums(batches):
        total = np.zeros(2 + size + size * size)
        for batch in batches:
            for at in range(0, batch.num_rows, 8192):
                part = passed(_rows(batch.slice(at, 8192)), edges, theta)
                total += np.concatenate([[part.n, part.loss], part.gradient, part.curvature.reshape(-1)])
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["i", "v"])

    found = measured.select("measures").mapInArrow(sums, "i long, v double").groupBy("i").agg(F.sum("v").alias("v")).toPandas()
    total = np.zeros(2 + size + size * size)
    total[found["i"].to_numpy()] = found["v"].to_numpy()
    return Pass(total[0], total[1], total[2:2 + size], total[2 + size:].reshape(size, size))


def _counted_above(measured: DataFrame, edges: list[np.ndarray], theta: np.ndarray, at: np.ndarray) -> np.ndarray:
    def count(batches):
        total = np.zeros(len(at), np.int64)
        for batch in batches:
            total += _above(_rows(batch), edges, theta, at)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(at))), pa.array(total)], names=["i", "n"])

    rows = measured.select("measures").mapInArrow(count, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).orderBy("i").collect()
    return np.array([r.n for r in rows], float)


def train(measured: DataFrame, labels: DataFrame, most_labelled: int = 20_000, prior: float | None = None, bins: int = 24) -> Model:
    """A model from the measures of all texts (doc_id, measures; read once a
    Newton step, so written) and the labels of rows that are not held out.

    Trusted positives are the rows labelled 1 in labels (doc_id, quality);
    unlabelled ones are all rows; those labelled 0 only calibrate.  Of either
    label at most ``most_labelled`` rows are taken, those with the smallest
    hashes of their id.  Null and contradicting labels are left out, labels of
    unknown ids unused.  Without positives the score is the prior everywhere
    (0.5 unless given).
    """
    known = (labels.where("doc_id is not null and quality is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
             .groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("other")).where("quality = other").where(~held_out()).drop("other"))
    some = measured.where("doc_id is not null").join(known, "doc_id")
    some = [some.where(F.col("quality") == q).orderBy(F.xxhash64("doc_id"), "doc_id", "measures").limit(most_labelled).select("measures").collect() for q in (1, 0)]
    good, bad = (np.array([r.measures for r in rows], np.float32).reshape(-1, len(MEASURES)) for rows in some)
    if not len(good):
        p = 0.5 if prior is None else prior
        return Model([np.zeros(0)] * len(MEASURES), np.zeros(len(MEASURES)), float(np.log(p / (1 - p))), p)
    cuts = [i / bins for i in range(1, bins)]
    row = measured.agg(F.count("*").alias("n"), *[F.percentile_approx(F.col("measures")[i], cuts, 1000).alias(f"q{i}") for i in range(len(MEASURES))]).first()
    edges = [np.unique(np.array(row[f"q{i}"], np.float32)) for i in range(len(MEASURES))]
    model = learnt(lambda theta: _summed(measured, edges, theta), lambda theta, at: _counted_above(measured, edges, theta, at), row["n"], good, edges, prior)
    return model.calibrated(good, bad)


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """doc_id, score (0 to 1; higher: label 1 likelier); one row per input row.

    Null and empty texts are measured as empty and scored like any other.
    Rows with a null id are scored and unlabelled.  Repeated rows get equal
    scores.  Without labels to learn from, every score is the prior.
    Other columns are ignored; an empty table gives an empty result.
    """
    measured = materialize(measures(docs, id_col, text_col), "measures")
    model = tuple(train(measured, labels, **options))

    def score(batches):
        judge = Model(*model)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(judge.score(_rows(batch)), pa.float64())], names=["doc_id", "score"])

    return measured.mapInArrow(score, "doc_id long, score double")


def keep_good(docs: DataFrame, labels: DataFrame, least: float = 0.3, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that score ``least`` or more; every row
    by its own text, also of repeated and null ids.  Null and empty texts are
    scored like any other; an empty table gives an empty result."""
    learnt_from = materialize(measures(docs, id_col, text_col), "measures")
    fitted = tuple(train(learnt_from, labels, **options))
    place, names = docs.columns.index(text_col), docs.columns

    def keep(batches):
        model = Model(*fitted)
        for batch in batches:
            ok = [model.score(_measure(data, off)) >= least for _, data, off in runs(batch.column(place))]
            if ok:
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(np.concatenate(ok))) for c in batch.columns], names=names)

    return docs.mapInArrow(keep, docs.schema)


def digests(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """doc_id, held_out, score, predicted."""
    return scored(docs, labels, **options).select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
