import math
import random

import numpy as np
import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import functions as F

from recengine.operators import attention as AT
from recengine.operators import metrics as MT
from recengine.operators import scoring as SC
from recengine.operators import vectors as V


def scored(spark, n=3000, seed=3):
    rnd = random.Random(seed)
    rows = []
    for _ in range(n):
        y = rnd.random() < 0.4
        p = round(min(0.999, max(0.001, rnd.gauss(0.6 if y else 0.4, 0.2))), 3)
        rows.append((p, int(y)))
    return spark.createDataFrame(rows, "p double, label int")


def test_areas_match_spark_evaluator(spark):
    df = scored(spark)
    got = MT.areas(df, buckets=7).collect()[0]
    ev = df.select(F.col("p").alias("rawPrediction"), F.col("label").cast("double").alias("label"))
    roc = BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0).evaluate(ev)
    pr = BinaryClassificationEvaluator(metricName="areaUnderPR", numBins=0).evaluate(ev)
    assert abs(got["roc_auc"] - roc) < 1e-9
    assert abs(got["pr_auc"] - pr) < 1e-9


def test_areas_independent_of_bucket_count(spark):
    df = scored(spark, 2000, 5)
    a = MT.areas(df, buckets=1).collect()[0]
    b = MT.areas(df, buckets=50).collect()[0]
    assert abs(a["roc_auc"] - b["roc_auc"]) < 1e-12 and abs(a["pr_auc"] - b["pr_auc"]) < 1e-12


def test_dense_forward_equals_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(50, 6))
    df = spark.createDataFrame([(i, [float(v) for v in x[i]]) for i in range(50)], "k long, f array<double>")
    layers = SC.rule_layers([6, 8, 1])
    got = {r["k"]: r["score"] for r in SC.dense_forward(df, "f", ["k"], layers).collect()}
    want = SC.forward_numpy(x, layers)
    assert max(abs(got[i] - want[i]) for i in range(50)) < 1e-12


def test_attention_weights_and_mask(spark):
    d = 4
    df = spark.createDataFrame([([[1.0] * d, [0.5] * d, [0.0] * d], [1, 1, 0], [0.2] * d)],
                               "history_vectors array<array<double>>, history_mask array<int>, item_vector array<double>")
    r = AT.attention_pool(df, d).collect()[0]
    w = r["attention_weights"]
    assert 0 < w[0] < 1 and 0 < w[1] < 1 and w[2] == 0.0
    assert abs(r["pooled_history"][0] - round(w[0] * 1.0 + w[1] * 0.5, 6)) < 1e-6


def test_lookup_zero_vector_and_topk(spark):
    vec = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 1.0]), (4, [2.0, 0.1])],
                                "id long, vector array<double>")
    q = spark.createDataFrame([(1,), (9,)], "movieId long")
    got = {r["movieId"]: r["v"] for r in V.lookup(q, vec, "movieId", "v", 2).collect()}
    assert got[9] == [0.0, 0.0] and got[1] == [1.0, 0.0]
    sim = [r["id"] for r in V.top_k_similar(vec, 1, k=2).collect()]
    assert sim == [4, 3]
    assert V.top_k_similar(vec, 99, k=2).count() == 0
    near = [r["id"] for r in V.k_nearest(vec, [1.0, 0.0], k=2).collect()]
    assert near == [1, 3]


def test_history_lookup_paths_agree(spark):
    vec = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(10)], "id long, vector array<double>")
    df = spark.createDataFrame([(1, 3, None), (2, None, 4)], "k long, a long, b long")
    small = V.history_lookup(df, vec, ["a", "b"], 2).orderBy("k").collect()
    large = V.history_lookup(df, vec, ["a", "b"], 2, max_broadcast_rows=1).orderBy("k").collect()
    assert [(r["history_vectors"], r["history_mask"]) for r in small] == \
           [(r["history_vectors"], r["history_mask"]) for r in large]
    assert small[0]["history_vectors"] == [[3.0, 1.0], [0.0, 0.0]] and small[0]["history_mask"] == [1, 0]


def test_neighbouring_rows_ask_for_a_vector_once(spark, monkeypatch):
    monkeypatch.setattr(V, "BLOCK_ROWS", 8)
    rows = [(u, t, 10 + t, *[10 + t - i if t > i else None for i in range(1, 4)]) for u in range(5) for t in range(40)]
    df = spark.createDataFrame(rows, "u long, t long, m long, a long, b long, c long").coalesce(1)
    # Numbers that no float holds, a null number, a null vector and ids without a vector.
    vec = spark.createDataFrame([(i, None if i == 20 else [0.1 * i, None if i == 21 else 1.0]) for i in range(10, 45)], "id long, vector array<double>")
    asked = V.asked(df.withColumn("_block", F.floor(F.monotonically_increasing_id() / 8)), ["a", "b", "c"])
    slots = sum(x is not None for r in rows for x in r[3:])
    assert asked.count() < slots / 2
    for table in (vec, vec.withColumn("vector", F.transform("vector", lambda x: x.cast("float").cast("double")))):
        small = V.history_lookup(df, table, ["a", "b", "c"], 2, item=("m", "own"))
        large = V.history_lookup(df, table, ["a", "b", "c"], 2, max_broadcast_rows=1, item=("m", "own"))
        assert small.columns == large.columns and large.count() == len(rows)
        assert small.exceptAll(large).count() == 0 and large.exceptAll(small).count() == 0
    assert V.travelling(vec).schema["vector"].dataType.simpleString() == "array<double>"
    assert V.travelling(table).schema["vector"].dataType.simpleString() == "array<float>"


def test_lsh_recall_on_fixture_vectors(spark):
    from tests.conftest import SF
    from recengine.sources import fixtures as X

    vecs = X.item_vectors(spark, SF)
    probe = vecs.where("id = 0").collect()[0]["vector"]
    exact = {r["id"] for r in V.k_nearest(vecs, list(probe), k=5).collect()}
    model, df = V.lsh_model(vecs, bucket_length=4.0)
    approx = {int(r["id"]) for r in V.lsh_nearest(model, df, list(probe), 5).collect()}
    assert len(exact & approx) / 5 >= 0.8


def test_attention_net_matches_row_loop(spark):
    d = 3
    rng = np.random.default_rng(1)
    rows = []
    for k in range(20):
        h = [[float(x) for x in rng.normal(size=d)] for _ in range(5)]
        m = [int(x) for x in rng.integers(0, 2, size=5)]
        rows.append((k, h, m, [float(x) for x in rng.normal(size=d)]))
    df = spark.createDataFrame(rows, "k long, history_vectors array<array<double>>, history_mask array<int>, "
                                     "item_vector array<double>")
    layers = SC.rule_layers([4 * d, 32, 1])
    got = {r["k"]: r for r in AT.attention_net(df, d, ["k"], layers).collect()}
    (w1, b1), (w2, b2) = layers
    for k, h, m, c in rows:
        pooled = np.zeros(d)
        for i in range(5):
            if not m[i]:
                assert got[k]["attention_weights"][i] == 0.0
                continue
            hv, cv = np.array(h[i]), np.array(c)
            z = np.concatenate([hv - cv, hv, cv, hv * cv]) @ w1 + b1
            z = np.where(z > 0, z, 0.25 * z)
            w = 1 / (1 + np.exp(-(z @ w2 + b2)[0]))
            assert abs(got[k]["attention_weights"][i] - w) < 1e-12
            pooled += w * hv
        assert np.allclose(got[k]["pooled_history"], pooled, atol=1e-12)


def test_attention_pool_runs_in_batches_and_keeps_odd_rows(spark):
    d = 3
    rng = np.random.default_rng(2)
    vector = lambda: [float(x) for x in rng.normal(size=d)]
    rows = [(k, [vector() for _ in range(5)], [int(x) for x in rng.integers(0, 2, size=5)], vector()) for k in range(20)]
    rows += [(20, None, [1] * 5, vector()), (21, [vector(), [1.0, None, 2.0]], [1, 1], vector()), (22, [vector(), None], [1, 0], vector()),
             (23, [vector()] * 2, [1, None], vector()), (24, [vector()] * 2, [1, 0], None), (25, [], [], vector())]
    df = spark.createDataFrame(rows, "k long, history_vectors array<array<double>>, history_mask array<int>, item_vector array<double>").coalesce(1)
    pooled = AT.attention_pool(df, d)
    assert "ArrowEvalPython" in pooled._jdf.queryExecution().executedPlan().toString()
    got = {r["k"]: (r["attention_weights"], r["pooled_history"]) for r in pooled.collect()}
    coef = [AT.rule_weights(k, d) for k in range(4)]
    for k, h, m, c in rows[:20]:
        w = [1 / (1 + math.exp(-(AT.ATTENTION_BIAS + sum(coef[0][j] * (x[j] - c[j]) + coef[1][j] * x[j] + coef[2][j] * c[j] + coef[3][j] * x[j] * c[j]
                                                         for j in range(d))))) if on else 0.0 for x, on in zip(h, m)]
        assert got[k][0] == pytest.approx(w, abs=6e-7) and got[k][1] == pytest.approx([sum(a * x[j] for a, x in zip(w, h)) for j in range(d)], abs=6e-7)
        assert all(x == round(x, 6) for part in got[k] for x in part)
    assert got[20] == (None, None) and got[21][0][0] is not None and got[21][0][1] is None and got[21][1] == [None] * d
    assert got[22][0][1] == 0.0 and got[22][1] is None and got[23][0][1] == 0.0 and None not in got[23][1]
    assert got[24] == ([None, 0.0], [None] * d) and got[25] == ([], [0.0] * d)
