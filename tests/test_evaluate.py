import random

import numpy as np
import pytest

from tagmill import session
from tagmill.operators import evaluate, labels, model


def tables(spark, y_true, y_pred):
    n, c = y_true.shape
    scores = spark.createDataFrame([(i, j, float(y_pred[i, j])) for i in range(n) for j in range(c)], "sample_id long, class_idx long, score double")
    truth = spark.createDataFrame([(i, j) for i in range(n) for j in range(c) if y_true[i, j]], "sample_id long, class_idx long")
    return scores, truth


def brute_force(y_true, y_pred, k):
    eps = 1e-10
    hard = y_pred > 0.5
    precisions, recalls, hits, aps = [], [], [], []
    for t, h, s in zip(y_true.astype(bool), hard, y_pred):
        tp = (t & h).sum()
        precisions.append(tp / (h.sum() + eps))
        recalls.append(tp / (t.sum() + eps))
        best = sorted(range(len(s)), key=lambda j: (-s[j], j))[:k]
        hits.append(any(t[j] for j in best))
        if t.any():
            found, gain = 0, 0.0
            for rank, j in enumerate(best, 1):
                if t[j]:
                    found += 1
                    gain += found / rank
            aps.append(gain / min(t.sum(), k))
    p, r = np.mean(precisions), np.mean(recalls)
    return [p, r, 2 * p * r / (p + r + eps), (y_true.astype(bool) == hard).mean(), np.mean(hits), np.mean(aps)]


@pytest.mark.parametrize("seed", [0, 1])
def test_metrics_match_dense_matrices(spark, seed):
    rng = np.random.default_rng(seed)
    y_pred = rng.random((40, 9)).round(2)
    y_true = (rng.random((40, 9)) < 0.25).astype(int)
    y_true[:3] = 0
    y_pred[3:6] = 0.1
    got = evaluate.metrics(*tables(spark, y_true, y_pred), 3).first()
    assert list(got) == pytest.approx(brute_force(y_true, y_pred, 3), abs=1e-9)
    assert all(0 <= v <= 1 for v in got)


def test_hand_computed_average_precision(spark):
    y_true, y_pred = np.array([[1, 0, 1, 0]]), np.array([[0.9, 0.8, 0.7, 0.1]])
    got = evaluate.mean_average_precision(*tables(spark, y_true, y_pred), 3).first()[0]
    assert got == pytest.approx((1 + 2 / 3) / 2)


def test_vocabulary_round_trip(spark):
    data = spark.createDataFrame([(1, "a.jpg", ["b", "a"]), (2, "b.jpg", ["c", "a", "a"]), (3, None, ["d"])], "id long, image string, tags array<string>")
    long = labels.long_tags(data)
    vocab = labels.vocabulary(long)
    assert [(r.idx, r.tag) for r in vocab.orderBy("idx").collect()] == [(0, "a"), (1, "b"), (2, "c"), (3, "d")]
    encoded = labels.encode_labels(long.unionByName(long.limit(0)), vocab.where("idx < 3"))
    assert sorted(map(tuple, encoded.collect())) == [(1, 0), (1, 1), (2, 0), (2, 2)]
    hot = {r.id: list(r.label) for r in labels.multi_hot(encoded, 3).collect()}
    assert hot == {1: [1, 1, 0], 2: [1, 0, 1]}
    wide = labels.to_wide(data)
    assert wide.columns == ["image", "tag1", "tag2", "tag3", "tag4", "tag5"]
    assert sorted((r.image, r.slot, r.tag) for r in labels.from_wide(wide).collect()) == [
        ("a.jpg", 1, "b"), ("a.jpg", 2, "a"), ("b.jpg", 1, "c"), ("b.jpg", 2, "a"), ("b.jpg", 3, "a"),
    ]


def test_frequent_tags_are_dealt_to_several_tasks(spark, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    rows = [(i, "often") for i in range(2000)] + [(i, f"tag {i % 700}") for i in range(1400)]
    rows += [(1, "often"), (1, "tag 1"), (None, "often"), (None, "often"), (None, "tag 3"), (5, None), (6, "unknown"), (7, "unknown")]
    tags = spark.createDataFrame(rows, "id long, tag string")
    names = sorted({t for _, t in rows if t} - {"unknown"})
    vocab = spark.createDataFrame(list(enumerate(names)), "idx long, tag string")
    for broadcast in (0, 1 << 16):
        monkeypatch.setattr(labels, "BROADCAST_TAGS", broadcast, raising=False)
        encoded = labels.encode_labels(tags, vocab)
        found = encoded.rdd.glom().map(lambda part: [tuple(r) for r in part]).collect()
        assert max(map(len, found)) <= 800
        want = {(i, names.index(t)) for i, t in rows if t in names}
        assert sorted((r for part in found for r in part), key=repr) == sorted(want, key=repr)
        decoded = labels.decode_labels(encoded, vocab)
        assert decoded.columns == ["class_idx", "id", "tag"]
        assert max(decoded.rdd.glom().map(len).collect()) <= 800
        assert sorted(map(tuple, decoded.collect()), key=repr) == sorted(((c, i, names[c]) for i, c in want), key=repr)


def test_tasks_of_a_driving_table_are_bounded_by_rows(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(session, "TASK_ROWS", 50, raising=False)
    path = str(tmp_path / "rows")
    spark.range(1000).coalesce(1).write.parquet(path)
    parts = session.spread(spark.read.parquet(path), "id").rdd.glom().map(len).collect()
    assert sum(parts) == 1000 and max(parts) <= 100


def test_block_scoring_equals_one_block(spark, monkeypatch):
    rng = random.Random(1)
    features = spark.createDataFrame(
        [(i, [rng.random() for _ in range(4)]) for i in range(30)] + [(30, None), (31, [1.0])], "sample_id long, features array<double>"
    )
    weights = spark.createDataFrame([(c, [rng.uniform(-1, 1) for _ in range(4)], rng.uniform(-1, 1)) for c in range(11)], "class_idx long, coef array<double>, intercept double")
    whole = {r.sample_id: r.top for r in model.predict_top_k(features, weights, 3).collect()}
    monkeypatch.setattr(model, "BLOCK_BYTES", 4 * 8 * 4)
    monkeypatch.setattr(model, "BROADCAST_BYTES", 0)
    blocks = {r.sample_id: r.top for r in model.predict_top_k(features, weights, 3).collect()}
    assert len(whole) == 32 and whole[30] == [] and whole[31] == []
    for i in whole:
        assert [t.class_idx for t in whole[i]] == [t.class_idx for t in blocks[i]]
        assert [t.score for t in whole[i]] == pytest.approx([t.score for t in blocks[i]])
    vocab = spark.createDataFrame([(c, f"c{c}") for c in range(10)], "idx long, tag string")
    samples = spark.createDataFrame([(i, f"{i}.png") for i in range(32)], "sample_id long, image string")
    records = {r.image: r.tags for r in model.prediction_records(model.name_predictions(model.predict_top_k(features, weights, 3), vocab), samples, 2).collect()}
    assert records["30.png"] == [] and all(len(t) <= 2 for t in records.values())


def test_fit_separates_simple_classes(spark):
    rows = [(i, [float(i % 2), float(i % 3 == 0)]) for i in range(120)]
    features = spark.createDataFrame(rows, "sample_id long, features array<double>")
    truth = spark.createDataFrame([(i, 0) for i in range(120) if i % 2] + [(i, 1) for i in range(120) if i % 3 == 0], "sample_id long, class_idx long")
    weights = model.fit(features, truth, iterations=20, regularisation=1e-4)
    scored = model.predict_top_k(features, weights, 2)
    from pyspark.sql import functions as F

    cells = scored.select("sample_id", F.explode("top").alias("t")).select("sample_id", "t.class_idx", "t.score")
    assert evaluate.hamming_accuracy(cells, truth).first()[0] == 1.0


def plain_fit(x, y, iterations, shrink):
    """Accelerated gradient steps on one class."""
    x = np.c_[x, np.ones(len(x))]
    step = 1 / (0.25 * (x * x).sum() / len(x) + shrink)
    v, w, keep = np.zeros(x.shape[1]), np.zeros(x.shape[1]), np.r_[np.ones(x.shape[1] - 1), 0]
    for k in range(iterations):
        g = x.T @ (1 / (1 + np.exp(-(x @ w))) - y) / len(x) + shrink * keep * w
        new = w - step * g
        v, w = new, new + k / (k + 3) * (new - v)
    return v


def test_all_classes_are_fitted_together_whatever_the_blocks(spark, monkeypatch):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(300, 5)).round(3)
    y = {c: x[:, c % 5] + 0.3 * rng.normal(size=300) > 0.4 for c in range(9)}
    features = [(i, r.tolist()) for i, r in enumerate(x)] + [(900, None), (901, [1.0]), (902, [float("nan")] * 5), (903, [0.1, None, 0.1, 0.1, 0.1])]
    labels = [(i, c) for c in y for i in range(300) if y[c][i]]
    df = spark.createDataFrame(features, "sample_id long, features array<double>").repartition(3)
    truth = spark.createDataFrame(labels + labels[:50] + [(900, 1), (901, 2), (902, 3), (None, 3), (5, None)], "sample_id long, class_idx long")
    asked = spark.createDataFrame([(c,) for c in range(10)], "class_idx long")
    for name, value in (("SLAB", 64), ("BLOCK_BYTES", 150), ("BROADCAST_BYTES", 0), ("SUMMED_BYTES", 300)):
        monkeypatch.setattr(model, name, value)
    fitted = {r["class_idx"]: [*r["coef"], r["intercept"]] for r in model.fit(df, truth, asked, iterations=4).collect()}
    assert sorted(fitted) == list(range(10))
    for c in range(9):
        assert fitted[c] == pytest.approx(plain_fit(x, y[c], 4, 0.01))
    assert fitted[9] == pytest.approx(plain_fit(x, np.zeros(300), 4, 0.01))


def test_fitting_nothing(spark):
    none = spark.createDataFrame([], "sample_id long, features array<double>")
    truth = spark.createDataFrame([(1, 7)], "sample_id long, class_idx long")
    assert [tuple(r) for r in model.fit(none, truth).collect()] == [(7, [], 0.0)]
    only_bad = spark.createDataFrame([(1, [float("nan")])], "sample_id long, features array<double>")
    assert [tuple(r) for r in model.fit(only_bad, truth).collect()] == [(7, [0.0], 0.0)]
    assert model.fit(only_bad, truth.limit(0)).count() == 0
    assert [tuple(r) for r in model.predict_top_k(only_bad, model.fit(only_bad, truth), 2).collect()] == [(1, [])]
