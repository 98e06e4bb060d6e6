"""Language, toxicity, mixing, secrets and the pipeline."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F

from recengine.llm import language, mixing, secrets, toxicity
from recengine.llm.common import crc_text

SF = "/root/testdata/sf0.001"


def test_crc_of_ids(spark):
    ids = [0, 1, 17, -5, 10**12]
    got = [r[0] for r in spark.createDataFrame([(i,) for i in ids], "i long").select(crc_text(F.col("i"))).collect()]
    assert got == [zlib.crc32(str(i).encode()) for i in ids]


def plain_places(text):
    """Hash places of all 1- to 3-grams, one by one."""
    text, out, mask = text.lower(), {}, (1 << 64) - 1
    for n in (1, 2, 3):
        for i in range(len(text) - n + 1):
            gram = 0
            for c in text[i:i + n]:
                gram = (gram * 0x1F123BB5 + ord(c)) & mask
            place = ((gram + n) * 0x9E3779B97F4A7C15 & mask) >> (64 - language.BITS)
            out[place] = out.get(place, 0) + 1
    return out


def test_ngram_counts_by_pieces(monkeypatch):
    text = "Ähnliche Sätze über 日本 x" * 9
    n = len(text.lower())
    places, many = language.counts(text)
    assert many.sum() == n + (n - 1) + (n - 2) and dict(zip(places.tolist(), many.tolist())) == plain_places(text)
    long = text * 200  # counted in a table
    assert dict(zip(*(x.tolist() for x in language.counts(long)))) == plain_places(long)
    monkeypatch.setattr(language, "PIECE", 7)
    assert dict(zip(*(x.tolist() for x in language.counts(text)))) == plain_places(text)
    assert language.counts("")[1].sum() == 0 and language.counts("a")[1].sum() == 1


def plain_language(model, text):
    """The prediction of a text from a full table of weights."""
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    v = {t: n * float(model.idf[t]) for t, n in plain_places(text).items()}
    norm = sum(x * x for x in v.values()) ** 0.5
    z = []
    for k in range(len(model.languages)):
        dense = {t: float(model.weights[model.rows[t], k]) for t in v if model.rows[t] >= 0}
        z.append((sum(v[t] * w for t, w in dense.items()) / norm + float(model.intercepts[k])) / model.temperature)
    e = [math.exp(x - max(z)) for x in z]
    return model.languages[e.index(max(e))], max(e) / sum(e)


def test_language_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = crc_text(F.col("doc_id")) % 4 == 2
    model = language.fit(docs, ~held)
    learned = [r for r in docs.where(~held).collect() if r["text"] is not None and r["lang"] is not None]
    seen = np.zeros(language.PLACES)
    for r in learned:
        for t in plain_places(r["text"]):
            seen[t] += 1
    assert np.allclose(model.idf, np.log((1 + len(learned)) / (1 + seen)) + 1)
    for r in language.predict(docs, model).collect():
        name, score = plain_language(model, r["text"])
        assert r["lang_pred"] == name and abs(r["score"] - score) < 1e-9


def test_more_languages_than_a_model_learns(spark, monkeypatch):
    monkeypatch.setattr(language, "MOST_LANGUAGES", 3)
    rows = [(i, f"{'abcd'[i % 4] * 5} text", f"l{i % 4}") for i in range(40)] + [(100, "zzz", "l0"), (101, "yyy", "l2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(docs, F.lit(True))
    assert model.languages == ["l0", "l1", "l2"]
    got = {r["doc_id"]: r["lang_pred"] for r in language.predict(docs, model).collect()}
    assert all(got[i] == f"l{i % 4}" for i in range(40) if i % 4 < 3) and {got[3]} <= set(model.languages)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    held = crc_text(F.col("doc_id")) % 4 == 2
    odd = spark.createDataFrame([(-1, None, "en"), (-2, "123 !?", "en"), (-3, "", None)], "doc_id long, text string, lang string")
    model = language.fit(docs.unionByName(odd), ~held)
    again = language.fit(docs.unionByName(odd), ~held)
    assert (model.weights == again.weights).all() and model.temperature == again.temperature
    # the penalties keep most weights at zero
    assert (model.weights != 0).sum() < 0.5 * (language.PLACES + 1) * len(model.languages)
    rows = language.predict(docs.withColumn("score", F.lit("clash")), model).where(held).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.9
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert {(r["lang_pred"], r["score"]) for r in language.predict(odd, model).collect()} == {("und", 0.0)}
    none = language.fit(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in language.predict(docs.limit(3), none).collect()} == {"und"}


def test_block_max_index_equals_brute_force():
    rng = random.Random(2)

    def vector():
        v = {rng.randrange(40): rng.random() for _ in range(rng.randrange(6))}
        norm = sum(x * x for x in v.values()) ** 0.5
        return {t: x / norm for t, x in v.items()} if norm else {}

    vectors = [vector() for _ in range(300)]
    vectors += vectors[:20]  # ties
    index = toxicity.BlockMaxIndex(vectors, block=16)
    for _ in range(100):
        q = vector()
        brute = sorted(((round(sum(w * v.get(t, 0.0) for t, w in q.items()), 12), i) for i, v in enumerate(vectors)), key=lambda x: (-x[0], x[1]))
        brute = [x for x in brute if x[0] > 0][:7]
        got = index.nearest(q, 7)
        assert [i for _, i in got] == [i for _, i in brute] and [x for x, _ in got] == pytest.approx([x for x, _ in brute])


def test_pruned_blocks_are_not_scored():
    rng = random.Random(8)
    vectors = []
    for i in range(640):  # each group of 16 shares a strong term of its own; all share a weak one
        v = {0: 0.2, 1 + i // 16: 0.9, 100 + rng.randrange(50): 0.3}
        norm = sum(x * x for x in v.values()) ** 0.5
        vectors.append({t: x / norm for t, x in v.items()})
    index = toxicity.BlockMaxIndex(vectors, block=16)
    got = index.nearest({0: 0.1, 5: 1.0}, 7)
    assert [i for _, i in got] == list(range(64, 71)) or {i for _, i in got} <= set(range(64, 80))
    assert 0 < index.scored <= 4 * 16 * 2 < sum(1 for v in vectors if 0 in v)


def plain_toxicity(model, vectors, text):
    """Score and neighbours of a text by comparing it with every example."""
    own = Counter()
    for w, n in Counter(re.findall(r"[^\W_]+", (text or "").lower())).items():
        marked = f"^{w}$"
        for t in [w, *(marked[i:i + 5] for i in range(max(0, len(marked) - 4)))]:
            if t in model.terms.ids:
                own[model.terms.ids[t]] += n
    v = {t: (1 + math.log(n)) * model.idf[t] for t, n in own.items()}
    norm = math.sqrt(sum(x * x for x in v.values())) or 1.0
    found = sorted(((-round(sum(x / norm * e.get(t, 0.0) for t, x in v.items()), 12), i) for i, e in enumerate(vectors)))
    near = [(-s, i) for s, i in found if s < 0][: model.k]
    vote = (sum(s * model.labels[i] for s, i in near) + 0.25 * model.base) / (sum(s for s, _ in near) + 0.25)
    vote = min(max(vote, 1e-4), 1 - 1e-4)
    return 1 / (1 + math.exp(-(model.slope * math.log(vote / (1 - vote)) + model.shift))), near


def test_toxicity_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = toxicity.fit(docs, labels, crc_text(F.col("doc_id")) % 5 != 0)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    seen = np.zeros(len(model.terms.ids))
    for t in texts.values():
        for i in model.terms.counts(t):
            seen[i] += 1
    assert np.allclose(model.idf, np.log((1 + len(texts)) / (1 + seen)) + 1)
    vectors = [model.vector(model.terms.counts(texts[i])) for i in model.ids]
    for r in toxicity.score(docs, model).collect():
        score, near = plain_toxicity(model, vectors, r["text"])
        assert abs(r["score"] - score) < 1e-9 and r["predicted"] == int(r["score"] >= 0.5)
        assert [e["similarity"] for e in r["evidence"]] == pytest.approx([s for s, _ in near])


def labelled(spark, n=300):
    rng = random.Random(3)
    bad = ["idiot", "scumbag", "loserling", "trashy"]
    rows, labels = [], []
    for i in range(n):
        toxic = i % 4 == 0
        w = [f"w{rng.randrange(200)}" for _ in range(rng.randrange(20, 60))]
        if toxic:
            for b in rng.sample(bad, 2):
                w.insert(rng.randrange(len(w)), b)
        rows.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    labels += [(0, 1, 0), (None, 1, 1), (1, 0, None), (9999, 1, 1)]
    docs = spark.createDataFrame(rows + [(10_000, None), (10_001, ""), (10_002, "IDIOT!! scumbag."), (None, "w1 w2")], "doc_id long, text string")
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity(spark):
    docs, labels = labelled(spark)
    learn = crc_text(F.col("doc_id")) % 5 != 0
    model = toxicity.fit(docs, labels, learn)
    rows = {r["doc_id"]: r for r in toxicity.score(docs.withColumn("near", F.lit(1)), model).collect()}
    held = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([rows[i]["predicted"] == int(i % 4 == 0) for i in held]) > 0.95
    assert rows[10_002]["predicted"] == 1 and {e["label"] for e in rows[10_002]["evidence"]} == {1}
    assert rows[10_000]["score"] == rows[10_001]["score"] < 0.5 and rows[10_000]["evidence"] == []
    assert all(0 <= r["score"] <= 1 for r in rows.values())
    none = toxicity.fit(docs, labels.limit(0), learn)
    assert {r["score"] for r in toxicity.score(docs, none).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def brute_targets(sizes, share=Fraction(3, 2), cap=2, weights=(5, 2, 1)):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    capped, total = set(), share * sum(sizes.values())
    while True:
        free = [s for s in names if s not in capped]
        rest = total - sum(cap * sizes[s] for s in capped)
        target = {s: Fraction(cap * sizes[s]) if s in capped else rest * w[s] / sum(w[x] for x in free) for s in names}
        above = {s for s in free if target[s] > cap * sizes[s]}
        if not above:
            return target
        capped |= above


def test_mixing(spark, monkeypatch):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rng = random.Random(5)
    rows = [(i, rng.choice(["hot"] * 6 + ["b", "é", "z", None]), " ".join(["x"] * rng.randrange(0, 40))) for i in range(600)]
    rows += [(700, "long", "y " * 5000), (701, "tiny", "y"), (702, "empty", ""), (702, "empty", ""), (None, "b", None), (703, "b", "p q"), (703, "b", "p q")]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id long, source string, text string, taken string")
    got = mixing.mix(df, block=64).collect()
    again = mixing.mix(df.repartition(7), block=64).collect()
    key = lambda r: str((r["doc_id"], r["source"], r["size"], r["taken"]))
    assert sorted(map(key, got)) == sorted(map(key, again)) and len(got) == len(rows)
    sizes, taken = {}, {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    target = brute_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and r["target"] == float(target[r["source"]])
    for s, t in target.items():
        assert abs(taken[s] - t) <= 0.5
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix(df.where("size(split(text, ' ')) = 1 and text = ''")).collect()} == {0}


def plain_walk(rows, block, cap=2):
    """(doc_id, source, size, taken, first slot, pieces): a walk over golden-ratio points through cumulative weights."""
    sizes = {}
    for _, s, t in rows:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    target = brute_targets(sizes)
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    quota = {s: min(math.floor(float(target[s]) + 0.5), cap * sizes[s]) for s in names}
    owner = [s for s in names for _ in range(-(-quota[s] // block))]
    n = len(owner)
    step = max(1, round(n * (5 ** 0.5 - 1) / 2))
    while n and math.gcd(step, n) != 1:
        step += 1
    queue = {}  # a source's words in shuffled order, as (row, words)
    for s in names:
        own = sorted((hashlib.md5(f"mix:{'' if i is None else i}".encode()).hexdigest(), len((t or "").split()), at)
                     for at, (i, src, t) in enumerate(rows) if src == s)
        queue[s] = [[at, size] for _ in range(cap) for _, size, at in own if size]
    out = {at: [0, None, 0] for at in range(len(rows))}
    left = dict(quota)
    for t in range(n):
        s = owner[t * step % n]
        room = min(block, left[s])
        left[s] -= room
        while room:
            at, size = queue[s][0]
            words = min(room, size)
            out[at] = [out[at][0] + words, t if out[at][1] is None else out[at][1], out[at][2] + 1]
            room, queue[s][0][1] = room - words, size - words
            if not queue[s][0][1]:
                queue[s].pop(0)
    return sorted(str((rows[at][0], rows[at][1], len((rows[at][2] or "").split()), *x)) for at, x in out.items())


@pytest.mark.parametrize("block", [7, 64, 5000])
def test_mix_follows_the_schedule(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "CHUNK", 16)
    rng = random.Random(6)
    rows = [(i, rng.choice(["hot"] * 4 + ["b", "é", None]), " ".join(["x"] * rng.randrange(0, 60))) for i in range(150)]
    rows += [(700, "long", "y " * 900), (701, "tiny", "y"), (702, "empty", "")]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id long, source string, text string").repartition(3), block=block)
    assert sorted(str((r["doc_id"], r["source"], r["size"], r["taken"], r["first_slot"], r["slots"])) for r in got.collect()) == plain_walk(rows, block)


def test_schedule_is_even(spark):
    from recengine.llm.common import Scratch

    sources = spark.createDataFrame([(0, 5000 * 64), (1, 2000 * 64), (2, 64), (3, 0)], "sid long, quota long")
    slots = mixing.schedule(Scratch(spark, "test"), sources, 64).orderBy("t").collect()
    assert len(slots) == 7001 and [r["rank"] for r in slots if r["sid"] == 0] == list(range(5000))
    for a in range(0, 7000, 350):  # every stretch of slots holds the sources in proportion
        assert abs(sum(r["sid"] == 0 for r in slots[a: a + 350]) - 250) <= 4


ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+))""")


def brute_base(text):
    found = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(found)


SECRETS = [None, "", "nothing", 'Password = "abcdefgh"', "token: secret: 'abcdefghijkl'", "API_KEY=12345678 apikey : short", "passwd:=x=y=z=12345",
           "AKIA" + "A1" * 6 + " AKIAshort AKIAAKIAAKIAAKIA", "é🎉 " + "0123456789abcdef" * 3 + "g" + "a" * 31, "f" * 100_000,
           "secret=abcdefgh" * 3, "ghp_" + "a" * 36 + " xoxb-1234567890 ://", "-----BEGIN RSA PRIVATE KEY-----", "ftp://me:passw0rd@host.org/x",
           "token = token = token = 12345678", "tokentoken:abcdefghi\ntoken\n:abcdefghi"]


@pytest.mark.parametrize("most", [500_000, 0])
def test_secrets_equal_brute_force(spark, monkeypatch, most):
    monkeypatch.setattr(secrets, "BROADCAST_TEXTS", most)
    rng = random.Random(9)
    parts = ["password", "token", "Secret", "api_key", "apikey", "=", ":", " ", '"', "'", "abc", "12345678", "AKIA", "ABCDEFGHIJKL", "0123456789abcdef", "é", "\n"]
    texts = SECRETS + ["".join(rng.choice(parts) for _ in range(rng.randrange(40))) for _ in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[3]), (None, None), (3, texts[3]), (3, "another text")]
    df = spark.createDataFrame([(i, t, "x", at) for at, (i, t) in enumerate(rows)], "doc_id long, text string, found string, at int")
    found = secrets.scan(df)
    base = secrets.base_only(F.col("found"))
    got = found.select("at", "doc_id", secrets.count_of(base, "hex").alias("n_hex"), secrets.joined(base).alias("base"),
                       F.sha2(secrets.joined(base).cast("binary"), 256).alias("sha"), "found",
                       secrets.masked(F.coalesce("text", F.lit("")), F.col("found")).alias("masked")).orderBy("at").collect()
    assert len(got) == len(rows)
    for r, (_, t) in zip(got, rows):
        expected = brute_base(t or "")
        want = ",".join(f"{k}:{a}:{b}" for a, _, b, k in expected)
        assert r["base"] == want and r["sha"] == hashlib.sha256(want.encode()).hexdigest()
        assert r["n_hex"] == sum(k == "hex" for *_, k in expected)
        spans = [(s["start"], s["end"]) for s in r["found"]]
        assert spans == sorted(spans, key=lambda s: s[0])
        out, at = "", 0
        for a, b in spans:
            if a >= at:
                out += (t or "")[at:a] + "[secret]"
            at = max(at, b)
        assert r["masked"] == out + (t or "")[at:]
    kinds = {s["kind"] for r in got for s in r["found"]}
    assert {"private_key", "github", "slack", "url_login"} <= kinds
    assert secrets.scan(df.limit(0)).count() == 0


def test_trigram_queries():
    queries = {r.kind: secrets.trigram_query(r) for r in secrets.BASE + secrets.MORE}
    assert queries["hex"] == secrets.ANY
    assert queries["access"] == {frozenset({"aki", "kia"})}
    assert frozenset({"sec", "ecr", "cre", "ret"}) in queries["assign"] and len(queries["assign"]) == 6  # one for each keyword
    none = secrets.trigram_query(secrets.Rule("x", r"(foo|ba?r)+[0-9]"))
    assert none == secrets.ANY  # 'br' has no trigram, so no trigram is mandatory
    assert secrets.trigram_query(secrets.Rule("x", r"(foo|ba?r)+[0-9]x?yz{2}")) == {frozenset({"yzz"})}
    assert secrets.trigram_query(secrets.Rule("x", r"abc[0-9]+defg")) == {frozenset({"abc", "def", "efg"})}


def test_pipeline_against_brute_force(spark):
    """Each stage, on what its predecessor kept, against a plain version of the same decision."""
    import corpus_pipeline
    from tests.llm.test_join_passages import brute_components

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, SF)
        assert name == "mixing" or after.columns == names
        path = f"{spark.sparkContext.getCheckpointDir()}/pipeline-test/{name}"
        after.write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
        kept[name] = {r["doc_id"]: r for r in docs.collect()}
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    clean = [i for i in rows if labels.get(i) == 0]
    assert sum(i in kept["toxicity"] for i in clean) >= 0.95 * len(clean)

    before = [(i, r["text"]) for i, r in kept["toxicity"].items()]
    assert set(kept["ngram_join"]) == {c for i, n, c in brute_components(before)}

    items = [re.findall(r"\w+", r["text"].lower()) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for i, r in kept["ngram_join"].items():
        text = " " + " ".join(re.findall(r"\w+", (r["text"] or "").lower())) + " "
        if any(f" {' '.join(x)} " in text for x in items):
            assert i not in kept["decontamination"]

    assert set(kept["secrets"]) == set(kept["decontamination"]) == set(kept["mixing"])
    for i, r in kept["decontamination"].items():
        text = kept["secrets"][i]["text"]
        assert not brute_base(text or "")
        if not secrets_anywhere(r["text"] or ""):
            assert text == r["text"]

    sizes, taken = {}, {}
    for i, r in kept["mixing"].items():
        n = len(re.findall(r"[^\x20\x09-\x0D]+", kept["secrets"][i]["text"] or ""))
        assert r["size"] == n and r["taken"] <= 2 * n
        sizes[r["source"]] = sizes.get(r["source"], 0) + n
        taken[r["source"]] = taken.get(r["source"], 0) + r["taken"]
    for source, target in brute_targets(sizes).items():
        assert abs(taken[source] - target) <= 0.5
    assert corpus_pipeline.run(spark, SF).count() == len(kept["mixing"])


def secrets_anywhere(text):
    return bool(brute_base(text)) or any(re.search(r.pattern, text) for r in secrets.MORE)
