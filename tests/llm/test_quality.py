import zlib

import duckdb
import numpy as np

from brute import SPACED, lower
from forkcast.llm import quality_pu
from forkcast.llm.queries import QUERIES

PATH = "/root/testdata/sf0.1"


def test_held_out_accuracy_on_a_whole_table(spark):
    rows = QUERIES["op1_pu_quality"](spark, PATH).collect()
    label = dict(duckdb.sql(f"select doc_id, quality from '{PATH}/labels.parquet'").fetchall())
    assert len(rows) == 10_000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.score, r.predicted, label[r.doc_id]) for r in rows if r.held_out and r.doc_id in label]
    score, predicted, truth = map(np.array, zip(*held))
    good, bad = score[truth == 1], score[truth == 0]
    auc = (good[:, None] > bad[None, :]).mean() + 0.5 * (good[:, None] == bad[None, :]).mean()
    print("held out", len(held), "auc", auc, "kept of good", (predicted[truth == 1]).mean(), "kept of bad", predicted[truth == 0].mean())
    assert auc > 0.97 and predicted[truth == 1].mean() > 0.98 and predicted[truth == 0].mean() < 0.2


def test_risk_never_profits_from_negative_part():
    rng = np.random.default_rng(0)
    k = len(quality_pu.MEASURES)
    good, bad = rng.normal(0, 1, (6000, k)), rng.normal(0, 1, (2000, k))
    good[:, 3] += 3
    bad[:, 3] -= 3
    model = quality_pu.fit(good[:3000].astype(np.float32), np.concatenate([good[3000:], bad]).astype(np.float32), 0.6)
    s_good, s_bad = model.score(good[3000:].astype(np.float32)), model.score(bad.astype(np.float32))
    assert (s_good > 0.5).mean() > 0.95 and (s_bad < 0.5).mean() > 0.95
    assert 0.4 < np.concatenate([s_good, s_bad]).mean() < 0.8


def plain_measures(text):
    """The measures of one text, word by word."""
    data = text.encode()
    words = SPACED.findall(text)
    low = [lower(w) for w in words]
    n, size = max(len(words), 1), max(len(data), 1)
    grams = lambda k: [tuple(low[i:i + k]) for i in range(len(low) - k + 1)]
    again = lambda k: len(grams(k)) - len(set(grams(k)))
    letters = sum(chr(b).isalpha() for b in data if b < 128)
    of = lambda chars: sum(c in chars for c in text)
    lengths = [len(w.encode()) for w in words]
    return [np.log1p(len(words)), sum(lengths) / n, sum(x > 14 for x in lengths) / n, sum(x < 3 for x in lengths) / n, 1 - again(1) / n, 1 - again(2) / n, again(5) / n, again(8) / n,
            sum("A" <= c <= "Z" for c in text) / max(letters, 1), sum("A" <= w[0] <= "Z" for w in words) / n, of("0123456789") / size, sum(b >= 128 for b in data) / size,
            of(".") / n, of(",") / n, of("!") / n, of("?") / n, of("|") / n, of("#*$%&<>") / n, of("\"'()[]{}/\\_=+~^@:;-") / n, of("\n") / n,
            max([low.count(w) for w in low], default=0) / n, len(words) / max(of(".!?"), 1)]


def test_measures_word_by_word(spark):
    texts = [None, "", " \n", "One two, two. THREE|four!\n\nOne two? [x] 12 été 東京 " * 7, "a b c d e f g h " * 3, "x" * 100_000, *(t for t, in duckdb.sql(f"select text from '{PATH.replace('0.1', '0.001')}/documents.parquet'").fetchall())]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality_pu.measures(df).collect():
        assert np.allclose(r.measures, plain_measures(texts[r.doc_id] or ""), rtol=1e-5, atol=1e-6), texts[r.doc_id]


def test_passes_over_the_table_equal_those_in_one_place(spark):
    rng = np.random.default_rng(2)
    k = len(quality_pu.MEASURES)
    x = rng.normal(0, 1, (500, k)).round(1).astype(np.float32)
    df = spark.createDataFrame([(i, row.tolist()) for i, row in enumerate(x)], "doc_id long, measures array<float>").repartition(5)
    edges = [np.unique(np.quantile(x[:, i], [0.25, 0.5, 0.75])) for i in range(k)]
    theta = rng.normal(0, 0.3, quality_pu._width(edges))
    here, there = quality_pu.passed(x, edges, theta), quality_pu._summed(df, edges, theta)
    assert all(np.allclose(a, b) for a, b in zip(here, there))
    assert np.array_equal(quality_pu._above(x, edges, theta, np.array([-1.0, 0.0, 0.5])), quality_pu._counted_above(df, edges, theta, np.array([-1.0, 0.0, 0.5])))
    # derivatives against finite differences, the loss against its definition
    one_hot = np.zeros((len(x), len(theta)))
    np.put_along_axis(one_hot, quality_pu._bins(x, edges), 1, 1)
    one_hot[:, -1] = 1
    loss = lambda t: np.log1p(np.exp(one_hot @ t)).sum()
    assert np.isclose(here.loss, loss(theta))
    for i in (0, 5, len(theta) - 1):
        step = np.eye(len(theta))[i] * 1e-5
        assert np.isclose(here.gradient[i], (loss(theta + step) - loss(theta - step)) / 2e-5, rtol=1e-4, atol=1e-4)
        assert np.allclose(here.curvature[i], (quality_pu.passed(x, edges, theta + step).gradient - quality_pu.passed(x, edges, theta - step).gradient) / 2e-5, rtol=1e-4, atol=1e-4)


def test_prior_and_second_part():
    rng = np.random.default_rng(1)
    k = len(quality_pu.MEASURES)
    for share in (0.3, 0.85):
        good = lambda n: (rng.normal(0, 1, (n, k)) + np.eye(k)[3] * 3).astype(np.float32)
        bad = (rng.normal(0, 1, (int(8000 * (1 - share)), k)) - np.eye(k)[3] * 2).astype(np.float32)
        unlabelled, positive = np.concatenate([good(int(8000 * share)), bad]), good(1500)
        model = quality_pu.fit(positive, unlabelled)
        assert abs(model.prior - share) < 0.1
        theta = np.append(model.weights, model.offset)
        _, second = quality_pu.risk(quality_pu.passed(unlabelled, model.edges, theta), positive, model.edges, theta, model.prior, np.zeros((len(theta), len(theta))))
        assert second >= 0


def test_odd_rows(spark):
    docs = spark.createDataFrame([(i, "Some plain words of text here. " * (i % 7 + 1), "x", 1) for i in range(60)] + [(None, None, None, None), (None, "a b", "", 0), (61, "", "", 0), (61, "", "", 0), (62, "word " * 60_000, "", 0)],
                                 "doc_id long, text string, quality string, measures int")
    labels = spark.createDataFrame([(i, i % 4 and 1, 0) for i in range(50)] + [(None, 1, 1), (5, None, 0), (6, 0, 0), (6, 1, 0), (999, 1, 1)], "doc_id long, quality int, toxic int")
    rows = quality_pu.digests(docs, labels).collect()
    assert len(rows) == 65 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id == 61}) == 1 and all(r.held_out is False for r in rows if r.doc_id is None)
    assert quality_pu.digests(docs.limit(0), labels).collect() == []
    assert {r.score for r in quality_pu.digests(docs, labels.limit(0)).collect()} == {0.5}
    kept = quality_pu.keep_good(docs, labels, least=0.0)
    assert kept.columns == docs.columns and kept.count() == 65


def test_labels_of_held_out_rows_change_nothing(spark):
    docs = spark.read.parquet(f"{PATH.replace('0.1', '0.001')}/documents.parquet")
    labels = spark.read.parquet(f"{PATH.replace('0.1', '0.001')}/labels.parquet")
    turned = labels.withColumn("quality", quality_pu.F.when(quality_pu.held_out(), 1 - labels.quality).otherwise(labels.quality))
    a, b = ({r.doc_id: r.score for r in quality_pu.digests(docs, x).collect()} for x in (labels, turned))
    assert a == b
