from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions import columns as C
from recengine.operators import encoders as E
from recengine.operators import users as U


def test_label_edges(spark):
    df = spark.createDataFrame([(3.4,), (3.5,), (3.6,), (None,)], "rating double")
    assert [r[0] for r in df.select(C.label("rating")).collect()] == [0, 1, 1, 0]


def test_release_year(spark):
    titles = ["Toy Story (1995)", "Foo (1995) ", "Babylon 5", None, "abc"]
    df = spark.createDataFrame([(t,) for t in titles], "title string")
    assert [r[0] for r in df.select(C.release_year("title")).collect()] == [1995, 1995, 1990, 1990, 1990]


def test_genre_slots(spark):
    df = spark.createDataFrame([("A|B|C|D",), ("A",), ("",), (None,)], "genres string")
    got = [tuple(r) for r in df.select(*[C.genre_slot("genres", i) for i in range(3)]).collect()]
    assert got == [("A", "B", "C"), ("A", None, None), ("", None, None), (None, None, None)]


def test_two_decimals(spark):
    df = spark.createDataFrame([(3.125,), (3.135,), (3.345,), (1234.5,), (0.005,)], "x double")
    assert [r[0] for r in df.select(C.two_decimals("x")).collect()] == ["3.12", "3.13", "3.35", "1,234.50", "0.01"]
    assert df.select(C.parse_number(C.two_decimals("x"))).collect()[3][0] == 1234.5


def test_id_bucket_and_vocab(spark):
    df = spark.createDataFrame([(-1,), (0,), (1000,), (1001,)], "id long")
    assert [r[0] for r in df.select(C.id_bucket("id", 1001)).collect()] == [None, 0, 1000, None]
    g = spark.createDataFrame([("Action",), ("Unknown",), (None,)], "g string")
    assert [r[0] for r in g.select(C.vocab_index("g", S.GENRE_VOCAB_MOVIELENS)).collect()] == [1, -1, -1]


def test_onehot_keeps_last(spark):
    df = spark.createDataFrame([(1,), (3,)], "movieId long")
    out, model = E.onehot_ids(df)
    vecs = [r["movieIdVector"] for r in out.orderBy("movieId").collect()]
    assert model.categorySizes == [4]
    assert [(v.size, list(v.indices), list(v.values)) for v in vecs] == [(4, [1], [1.0]), (4, [3], [1.0])]


def test_indicator_and_cross(spark):
    df = spark.createDataFrame([(2, 5, 7), (-1, None, 7)], "i int, a long, b long")
    rows = df.select(E.active_indices(E.indicator("i", 4)).alias("act"),
                     E.crossed_bucket("a", "b").alias("x")).collect()
    assert rows[0]["act"] == [2] and rows[1]["act"] == []
    assert 0 <= rows[0]["x"] < S.CROSS_BUCKETS and rows[1]["x"] is None


def test_md5_bucket_matches_python(spark):
    import hashlib

    df = spark.createDataFrame([(1, 2), (30, 4000)], "a long, b long")
    got = [r[0] for r in df.select(C.md5_bucket(["a", "b"], 1000, "s")).collect()]
    want = [int(hashlib.md5(f"s_{a}_{b}".encode()).hexdigest()[:8], 16) % 1000 for a, b in [(1, 2), (30, 4000)]]
    assert got == want


def inside_lambdas(df) -> str:
    """What the first line of a plan evaluates for each element of an array."""
    return df._jdf.queryExecution().analyzed().toString().splitlines()[0].partition("lambdafunction(")[2]


def test_indicators_build_their_arrays_once(spark):
    df = spark.createDataFrame([(i,) for i in (None, -1, 0, 2, 3, 4)], "i int")
    rows = df.select("i", E.indicator("i", 4).alias("one"), E.active_indices(F.concat(E.indicator("i", 4), E.indicator("i", 4))).alias("act"))
    for r in rows.collect():
        inside = r["i"] is not None and 0 <= r["i"] < 4
        assert r["one"] == [float(j == r["i"]) for j in range(4)]
        assert r["act"] == ([r["i"], r["i"] + 4] if inside else [])
    odd = spark.createDataFrame([([0.0, None, float("nan"), -0.0, 2.0],), (None,)], "a array<double>")
    assert [r[0] for r in odd.select(E.active_indices("a")).collect()] == [[2, 4], None]
    assert "array_repeat" not in inside_lambdas(rows) and "#" not in inside_lambdas(df.select(E.indicator("i", 4)))


def test_top_genres_build_their_array_once(spark):
    vocabulary = [f"g{i}" for i in range(7)]  # the last number has one genre
    rows = [[0, 0, 0, 0, 0, 0, 0], [1, 0, 3, 3, 0, 0, 9], [0, 0, 0, 0, 0, 0, 1], [1, 1, 1, 1, 1, 1, 1], [0, 7, 0, (1 << 20) - 1, 0, 7, 0]]
    pack = lambda x: [sum(n << (U.FIELD_BITS * i) for i, n in enumerate(x[at:at + U.FIELDS])) for at in range(0, 7, U.FIELDS)]
    df = spark.createDataFrame([(i, *pack(x)) for i, x in enumerate(rows)], "k int, _g0 long, _g1 long, _g2 long")
    ranked = df.withColumn("_top", U.top_genres(vocabulary))
    names = {k: c for k, c in U.user_feature_columns(vocabulary=vocabulary).items() if k.startswith("userGenre")}
    for r in ranked.select("k", *[c.alias(k) for k, c in names.items()]).collect():
        present = sorted((i for i in range(7) if rows[r["k"]][i]), key=lambda i: (-rows[r["k"]][i], i))
        assert [r[f"userGenre{i}"] for i in range(1, 6)] == ([vocabulary[i] for i in present] + [None] * 5)[:5]
    assert "_g0" not in inside_lambdas(ranked)
