"""N-gram join, repeated passages and decontamination against brute force."""

import random

import pytest

from recengine.llm import decontaminate, ngram_join, passages
from recengine.llm.shingles import words_of

SCHEMA = "doc_id long, text string, component_id string"


def sets_of(text, k=5):
    w = words_of(text)
    if not w:
        return set()
    return {tuple(w)} if len(w) < k else {tuple(w[i: i + k]) for i in range(len(w) - k + 1)}


def brute_components(rows):
    s = [sets_of(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            i = len(s[a] & s[b])
            if s[a] and s[b] and 100 * i >= 75 * (len(s[a]) + len(s[b]) - i):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for a, (key, _) in enumerate(rows):
        r = find(a)
        if key is not None:
            least[r] = min(least.get(r, key), key)
    return sorted(((key, len(s[a]), least.get(find(a)) if s[a] else key) for a, (key, _) in enumerate(rows)), key=str)


def corpus(seed, n_groups=12, copies=14, length=(5, 120)):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["the", "of"] * 20
    common = [rng.choice(vocabulary) for _ in range(60)]
    out = []
    for _ in range(n_groups):
        base = [rng.choice(vocabulary) for _ in range(rng.randint(*length))]
        if rng.random() < 0.5:
            base += common
        for _ in range(rng.randint(1, copies)):
            own = list(base)
            for _ in range(rng.randint(0, 6)):
                own[rng.randrange(len(own))] = rng.choice(vocabulary)
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # small chunks, so that long lists meet chunk by chunk
        monkeypatch.setattr(ngram_join, "CHUNK", 3)
    texts = corpus(seed) + [None, "", "  \t", "one two", "ONE two", "one two three", "A b\nc d e", "a b c d e", "x " * 3000, "x " * 4000]
    rows = [(3 * i % 1009, t) for i, t in enumerate(texts)] + [(7, "a b c d e"), (7, "a b c d e"), (None, texts[0]), (None, None)]
    df = spark.createDataFrame([(i, t, "clash") for i, t in rows], SCHEMA).repartition(3)
    got = sorted((tuple(r) for r in ngram_join.near_duplicates(df).collect()), key=str)
    assert got == brute_components(rows)


def near_copies(copies, words, most, seed=9):
    """Texts of one base with 1 to ``most`` changed words each."""
    rng = random.Random(seed)
    base = [f"b{i}" for i in range(words)]
    out = []
    for c in range(copies):
        own = list(base)
        for _ in range(rng.randint(1, most)):
            own[rng.randrange(words)] = f"c{c}x{rng.randrange(10 ** 9)}"
        out.append((c, " ".join(own)))
    return out


def test_pairs_of_a_large_group_grow_with_it(spark):
    verified = {}
    for copies in (500, 2000):
        rows = near_copies(copies, 120, 3)
        run = ngram_join.Join(spark.createDataFrame(rows, "key string, text string").selectExpr("*", "xxhash64(text) look"), 5, 75, 100)
        keep = run.scratch.keep_only
        run.scratch.keep_only = lambda *frames: None
        _, _, near = run.run()
        assert near.select("component").distinct().count() == 1 and near.count() > 0.98 * copies
        verified[copies] = sum(p.count() for p in run.pairs)
        keep()
    assert verified[2000] < 6 * verified[500] and verified[2000] < 12 * 2000, verified


@pytest.mark.parametrize("words,most,copies", [(60, 2, 150), (120, 3, 120), (40, 1, 60)])
def test_group_of_near_copies_equals_brute_force(spark, monkeypatch, words, most, copies):
    monkeypatch.setattr(ngram_join, "FEW", 1)  # many rounds
    monkeypatch.setattr(ngram_join, "BROADCAST_ROWS", 0)  # joins by shuffle
    rows = near_copies(copies, words, most)
    got = ngram_join.near_duplicates(spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA))
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_components(rows)


def test_one_of_each(spark):
    texts = corpus(5, n_groups=6)
    rows = [(i, t) for i, t in enumerate(texts)] + [(500, ""), (500, ""), (None, None), (0, texts[0]), (0, texts[0])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    kept = ngram_join.one_of_each(df)
    assert kept.columns == df.columns
    expected = {c for k, n, c in brute_components(rows) if n}
    words = [r for r in kept.collect() if r["text"]]
    assert sorted(r["doc_id"] for r in words) == sorted(expected)
    assert sum(1 for r in kept.collect() if not r["text"]) == 3


def test_join_of_nothing(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert ngram_join.near_duplicates(df).collect() == [] and ngram_join.one_of_each(df).collect() == []


def brute_passages(rows, n=50):
    seen = {}
    for i, t in rows:
        w = words_of(t)
        for a in range(len(w) - n + 1):
            seen.setdefault(tuple(w[a: a + n]), set()).add(i)
    return {i for v in seen.values() if len(v) > 1 for i in v}


def test_passages(spark):
    rng = random.Random(4)
    word = lambda: f"v{rng.randrange(5000)}"
    text = lambda n: [word() for _ in range(n)]
    passage, other = text(60), text(51)
    rows = []
    for i in range(40):
        t = text(rng.randint(20, 300))
        if i % 4 == 0:
            at = rng.randrange(len(t))
            t[at:at] = passage if i % 8 else other
        rows.append((i, " ".join(t)))
    rows += [(100, "be " * 500), (101, "be " * 700), (102, None), (103, ""), (104, " ".join(text(80))), (None, " ".join(passage))]
    rows += [(105, rows[1][1]), (106, " ".join(text(30) + passage[:30] + text(30)))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(4)
    got = passages.repeated_passages(df).collect()
    assert {r["doc_id"] for r in got} == brute_passages(rows)
    for r in got:
        if r["doc_id"] in range(0, 40, 4) and r["doc_id"] % 8:
            assert r["n_words"] == 60 and r["with_doc_id"] is not None
    assert passages.repeated_passages(df.limit(0)).collect() == []


def test_near_passages_and_copies_of_whole_texts(spark):
    rng = random.Random(6)
    text = lambda n: [f"v{rng.randrange(5000)}" for _ in range(n)]
    base = text(120)
    near = list(base)
    near[30] = near[90] = "changed"
    rows = [(1, " ".join(text(50) + base)), (2, " ".join(near + text(70))), (3, " ".join(text(200))), (4, " ".join(text(49)))]
    rows += [(5, rows[3][1]), (6, " ".join(text(55)))]
    rows += [(7, rows[5][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    got = {r["doc_id"]: r for r in passages.repeated_passages(df).collect()}
    assert set(got) == {1, 2, 6, 7}
    assert got[1]["first_word"] == 50 and got[1]["n_words"] == 120 and got[2]["n_words"] == 120


def test_compact_windows_cover_each_stretch_once():
    import numpy as np

    rng = np.random.default_rng(0)
    for h in (rng.integers(0, 50, 60), np.zeros(60, int), np.arange(60)):
        found = passages.compact_windows(h.astype(np.uint64), 10)
        for a in range(60):
            for z in range(a + 9, 60):
                own = [w for w in found if w[0] <= a <= w[1] <= z <= w[2]]
                assert len(own) == 1 and h[own[0][1]] == h[a: z + 1].min()


def test_leaks(spark):
    rng = random.Random(8)
    text = lambda n: [f"v{rng.randrange(900)}" for _ in range(n)]
    items = [text(n) for n in (15, 25, 40, 13, 60)] + [text(6)]
    marks = spark.createDataFrame([(i, " ".join(t), "x") for i, t in enumerate(items)] + [(9, None, "x"), (None, "a b", "x"), (2, " ".join(items[2]), "x")],
                                  "item_id long, text string, key string")
    docs, expected = [], set()
    for i in range(30):
        t = text(rng.randint(0, 200))
        if i % 3 == 0:
            own = list(items[i % 5])
            if i % 2:
                own[len(own) // 2] = "changed"
            at = rng.randint(0, len(t))
            t[at:at] = own
            expected.add((i, i % 5))
        docs.append((i, (", " if i % 4 == 0 else " ").join(t).upper() if i % 4 == 0 else " ".join(t)))
    docs += [(50, None), (51, ""), (52, " ".join(items[4][:9])), (53, " ".join(items[5])), (None, " ".join(items[1])), (0, docs[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, item string")
    found = decontaminate.find_leaks(df, marks)
    rows = found.collect()
    assert {(r["doc_id"], r["item_id"]) for r in rows} == expected | {(None, 1)} and len(rows) == len(expected) + 1
    clean = decontaminate.without_leaks(df, found)
    leaky = {d for d, _ in expected} | {None}
    assert sorted(r["doc_id"] for r in clean.collect()) == sorted(d for d, _ in docs if d not in leaky)
    assert decontaminate.find_leaks(df.limit(0), marks).collect() == []
    assert decontaminate.find_leaks(df, marks.limit(0)).collect() == []


def test_rows_without_id_are_kept_unless_they_leak(spark):
    item = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = [(None, f"so {item} so"), (None, "clean text"), (None, f"so {item} so"), (None, None), (4, f"and {item}"), (4, "clean"), (None, "clean text")]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, text_hash string")
    found = decontaminate.find_leaks(df, spark.createDataFrame([(1, item)], "item_id long, text string"))
    assert sorted(str(r["doc_id"]) for r in found.collect()) == ["4", "None"]
    clean = decontaminate.without_leaks(df, found)
    assert clean.columns == df.columns
    assert sorted(str((r["doc_id"], r["text"])) for r in clean.collect()) == sorted(map(str, [
        (None, "clean text"), (None, "clean text"), (None, None), (4, "clean")]))


def test_leaks_by_shuffle(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    test_leaks(spark)


@pytest.mark.parametrize("seed", [1, 2])
def test_passages_of_frequent_lines(spark, seed):
    rng = random.Random(seed)
    lines = [[f"l{i}w{j}" for j in range(10)] for i in range(12)]
    some = lambda n: [w for _ in range(n) for w in rng.choice(lines)]
    rows = [(i, " ".join(some(rng.randint(5, 9)))) for i in range(150)]
    rows += [(200, "be " * 400), (201, "be " * 300 + "end"), (202, rows[0][1])]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA).repartition(4)
    expected = brute_passages(rows)
    got = {r["doc_id"] for r in passages.repeated_passages(df, similarity=(100, 100)).collect()}
    assert got == expected and len(expected) < len(rows)


def test_whole_hashes_and_least_values():
    import numpy as np

    s = np.random.default_rng(3).integers(0, 3, 200).astype(np.uint64)
    found = passages.whole_hashes(s, 5)
    assert len({(tuple(s[i: i + 5]), found[i]) for i in range(196)}) == len(set(found)) == len({tuple(s[i: i + 5]) for i in range(196)})
    for width in (4, 7, 46):
        assert list(passages.least_of_each(s, width)) == [s[i: i + width].min() for i in range(201 - width)]


def test_passages_with_words_inserted_between_them(spark):
    rng = random.Random(12)
    text = lambda n: [f"v{rng.randrange(9000)}" for _ in range(n)]
    own = [text(60) for _ in range(20)]
    plain = [w for p in own for w in p]
    spaced = [w for p in own for w in p + text(8)]
    rows = [(1, " ".join(plain)), (2, " ".join(spaced)), (3, " ".join(text(300)))]
    df = spark.createDataFrame([(i, t, "x") for i, t in rows], SCHEMA)
    # Similarity 1: each shared passage by itself.
    got = {(r["doc_id"], r["first_word"], r["n_words"]) for r in passages.repeated_passages(df, similarity=(100, 100)).collect()}
    assert {(n, a) for i, a, n in got if i == 2} == {(60, 68 * j) for j in range(20)}
    near = [r for r in passages.repeated_passages(df).collect() if r["doc_id"] in (1, 2)]
    held = {r["doc_id"]: set() for r in near}
    for r in near:
        held[r["doc_id"]] |= set(range(r["first_word"], r["first_word"] + r["n_words"]))
    assert held[1] >= set(range(1200)) and all(set(range(68 * j, 68 * j + 60)) <= held[2] for j in range(20))


def test_masks_leave_a_seed_for_every_allowed_substitution():
    from itertools import combinations
    from math import ceil

    for n in range(1, 14):
        masks = decontaminate.short_masks(n) if n < 13 else decontaminate.MASKS
        for wrong in combinations(range(n), n - ceil(n * 0.8 - 1e-9)):
            assert any(all(m[i] == "0" or at + i not in wrong for i in range(len(m)))
                       for m in masks for at in range(n - len(m) + 1)), (n, wrong)


def test_leaks_with_many_substitutions_equal_brute_force(spark):
    rng = random.Random(21)
    text = lambda n: [f"v{rng.randrange(900)}" for _ in range(n)]
    items = [(None if n == 8 else n, text(n)) for n in (1, 4, 5, 6, 8, 9, 10, 12, 13, 15, 20, 30)]
    docs = []
    for i in range(120):
        own = list(items[i % len(items)][1])
        for j in (range(i % 5, len(own), 5) if i % 2 else rng.sample(range(len(own)), len(own) // 5)):
            own[j] = f"x{j}"
        docs.append((i, text(rng.randint(0, 20)) + own + text(rng.randint(0, 20))))

    def held(doc, item):
        size = min(len(item), 13)
        need = -(-size * 8 // 10)
        for shift in range(-len(item), len(doc)):
            same = [0 <= shift + j < len(doc) and doc[shift + j] == w for j, w in enumerate(item)]
            if any(sum(same[a: a + size]) >= need for a in range(len(item) - size + 1)):
                return True
        return False

    df = spark.createDataFrame([(i, " ".join(t)) for i, t in docs], "doc_id long, text string")
    marks = spark.createDataFrame([(i, " ".join(t)) for i, t in items], "item_id long, text string")
    got = [(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(df, marks, least_words=1).collect()]
    expected = {(d, i) for d, t in docs for i, w in items if held(t, w)}
    assert set(got) == expected and len(got) == len(expected) and any(i is None for _, i in got)


def near_pairs_of_frequent_lines(seed):
    """Pairs of documents with the same five lines in a row but for one word, among lines that many documents hold."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(10 ** 9)}"
    lines = [[word() for _ in range(14)] for _ in range(10)]
    rows = []
    for i in range(400):  # single lines in contexts of their own
        text = []
        for line in rng.sample(lines, 5):
            text += [*line, *[word() for _ in range(30)]]
        rows.append((i, " ".join(text)))
    for pair in range(6):
        order = rng.sample(lines, 5)
        for side in range(2):
            body = [w for line in order for w in line]
            if side:
                body[35] = word()
            rows.append((1000 + 2 * pair + side, " ".join([*[word() for _ in range(60)], *body, *[word() for _ in range(60)]])))
    return rows


@pytest.mark.parametrize("chunk", [1024, 50])
def test_near_passages_in_crowded_groups(spark, monkeypatch, chunk):
    monkeypatch.setattr(passages, "SEED_CHUNK", chunk)
    rows = near_pairs_of_frequent_lines(7)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: r for r in passages.repeated_passages(df).collect()}
    assert set(got) == set(range(1000, 1012))
    assert all(r["n_words"] >= 68 and 58 <= r["first_word"] <= 62 for r in got.values())


def test_shared_run_of_similar_sequences():
    assert passages.shared_run(5, 46, 75, 100) == 18 and passages.shared_run(5, 46, 100, 100) == 46
    rng = random.Random(2)
    run = passages.shared_run(5, 46, 75, 100)
    for _ in range(300):
        x = [f"a{i}" for i in range(rng.randrange(50, 150))]
        y = list(x)
        for _ in range(rng.randrange(1, 8)):
            at = rng.randrange(len(y))
            y[at:at + rng.randrange(2)] = [f"b{rng.random()}"][:rng.randrange(2)]
        left, right = ([tuple(z[i: i + 5]) for i in range(len(z) - 4)] for z in (x, y))
        shared = len(set(left) & set(right))
        if 100 * shared >= 75 * (len(left) + len(right) - shared) and min(len(left), len(right)) >= 46:
            runs = {tuple(right[i: i + run]) for i in range(len(right) - run + 1)}
            assert any(tuple(left[i: i + run]) in runs for i in range(len(left) - run + 1))
