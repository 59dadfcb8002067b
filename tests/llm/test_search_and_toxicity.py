"""Toxicity, hard negatives and lexical search against brute force and planted cases."""

import random
import re
from math import floor, log

import numpy as np
import pytest

from tagmill.llm import negatives, queries, ranking, toxicity

from tests.oracle import connect, rows

# --- toxicity


def best_by_definition(word, entries):
    out = None
    for text, stem, weight in entries:
        if word[0] != text[0]:
            continue
        starts = [word[:n] for n in range(len(word) + 1)] if stem else [word]
        edits = min(toxicity.levenshtein(s, text) for s in starts)
        if edits <= toxicity.allowance(len(text), stem):
            out = max(out or 0.0, weight * 0.5**edits)
    return out


def test_the_automaton_finds_what_edit_distances_find():
    rng = random.Random(3)
    word = lambda a, b: "".join(rng.choice("abc") for _ in range(rng.randint(a, b)))
    entries = sorted({(word(3, 11), rng.random() < 0.4): rng.uniform(1, 5) for _ in range(60)}.items())
    entries = [(t, s, w) for (t, s), w in entries]
    machine = toxicity.Automaton(toxicity.Trie(entries))
    found = 0
    for w in {word(1, 13) for _ in range(1500)} | {t for t, _, _ in entries}:
        hit, expected = machine.find(w), best_by_definition(w, entries)
        assert (hit is None) == (expected is None), w
        if hit:
            found += 1
            assert hit[1] * 0.5 ** hit[0] == pytest.approx(expected), w
    assert found > 300


def test_states_are_rebuilt_when_there_are_too_many(monkeypatch):
    entries = [("idiot", False, 2.0), ("worthless", False, 2.0)]
    monkeypatch.setattr(toxicity.Automaton, "STATES", 5)
    machine = toxicity.Automaton(toxicity.Trie(entries))
    assert [machine.find(w) for w in ("idiot", "idoit", "id1ot", "worthles", "worht", "wrthlss")] == [(0, 2.0), (1, 2.0), (0, 2.0), (1, 2.0), None, (2, 2.0)]


def test_contexts_tell_quotation_from_abuse():
    reader = toxicity.Reader(toxicity.Model([("idiot", False, 2.0)]))
    contexts = lambda text: [h[3] for h in reader.hits(text)]
    assert contexts("you are an idiot") == [toxicity.DIRECTED]
    assert contexts('he said "what an idiot" and left') == [toxicity.QUOTED]
    assert contexts("the word idiot is old") == [toxicity.QUOTED]
    assert contexts("an idiot stood there") == [toxicity.PLAIN]
    assert contexts("") == [] and contexts(None or "") == []


def test_a_long_text_is_read_whole(monkeypatch):
    rng = random.Random(5)
    text = " ".join(rng.choice(["idiot", "you", '"', "said", "stone", "river", "idoit"]) for _ in range(5000))
    model = toxicity.Model([("idiot", False, 2.0)])
    whole = toxicity.Reader(model).hits(text)
    monkeypatch.setattr(toxicity, "CHUNK", 97)
    assert toxicity.Reader(model).hits(text) == whole and len(whole) > 1000
    assert toxicity.Reader(model).hits("x" * 1000) == []


def toxic_rows(n=600):
    rng = random.Random(11)
    plain = [f"{a}{b}{c}" for a in "bdfglm" for b in "aeiou" for c in ("nd", "rk", "st", "lo", "mi")]
    out = []
    for i in range(n):
        words = [rng.choice(plain) for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                bad = rng.choice(["zumpelig", "idiot", "worthless"])
                words[rng.randrange(1, 39)] = bad + (rng.choice(["en", "er", ""]) if bad == "zumpelig" else "")
        elif i % 4 == 1:
            at = rng.randrange(2, 30)
            words[at : at + 3] = ['"', "idiot", '"']
        out.append((i, " ".join(words), int(toxic)))
    return out


def test_held_out_rows_are_told_apart(spark):
    data = toxic_rows()
    docs, labels = spark.createDataFrame(schema="doc_id long, text string", data=[r[:2] for r in data]), spark.createDataFrame(schema="doc_id long, toxic int", data=[(r[0], r[2]) for r in data])
    model = toxicity.fit(docs, labels)
    assert any(t.startswith("zumpelig") for t, _, _ in model.entries)
    scored = toxicity.score(docs, model).join(labels.withColumnRenamed("toxic", "truth"), "doc_id").where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0").collect()
    assert len(scored) > 80
    assert np.mean([r["toxic"] == r["truth"] for r in scored]) > 0.95
    planted = spark.createDataFrame(schema="doc_id long, text string", data=[(1, "barkst you zumpelgi idiiot worthles"), (2, "lond mist lark"), (3, None), (4, ""), (None, "idiot"), (4, "")])
    got = [(r["doc_id"], r["toxic"], r["n_hits"], r["n_misspelled"]) for r in toxicity.score(planted, model).collect()]
    assert sorted(got, key=str) == sorted([(1, 1, 3, 3), (2, 0, 0, 0), (3, 0, 0, 0), (4, 0, 0, 0), (4, 0, 0, 0), (None, got[4][1], 1, 0)], key=str)


def test_toxicity_without_labels_or_rows(spark):
    docs = spark.createDataFrame(schema="doc_id long, text string, toxic string", data=[(1, "you are an idiot and worthless", "x"), (2, "a river", None)])
    none = spark.createDataFrame(schema="doc_id long, toxic int", data=[])
    model = toxicity.fit(docs, none)
    assert {r["doc_id"]: r["toxic"] for r in toxicity.score(docs, model).collect()} == {1: 1, 2: 0}
    odd = spark.createDataFrame(schema="doc_id long, toxic int, text string", data=[(1, 1, "clash"), (1, 0, ""), (2, 0, None), (None, 1, ""), (3, None, ""), (3, 7, "")])
    assert toxicity.score(docs.limit(0), toxicity.fit(docs, odd)).count() == 0
    assert toxicity.score(docs, toxicity.fit(docs, odd)).columns[:2] == ["doc_id", "toxicity"]


def test_toxicity_query_has_the_contract(spark, sf_dir):
    df = queries.op11_toxicity(spark, sf_dir)
    assert df.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    got = df.collect()
    assert len(got) == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5) for r in got)


# --- hard negatives


def mined_by_definition(data, is_anchor, p=5, n=10):
    ints = {i: ([floor(256 * x) for x in v], l) for i, v, l in data}
    dot = lambda a, b: sum(x * y for x, y in zip(ints[a][0], ints[b][0]))
    out = []
    for a in filter(is_anchor, ints):
        ranked = sorted(((-dot(a, b), b) for b in ints if b != a))
        same = [(b, -s) for s, b in ranked if ints[b][1] == ints[a][1]][:p]
        for b, ps in same:
            inside = [(c, -s) for s, c in ranked if ints[c][1] != ints[a][1] and 30 * ps <= -100 * s <= 90 * ps][:n]
            out += [(a, b, k, c, ps, s) for k, (c, s) in enumerate(inside, 1)]
    return sorted(out)


def vectors(n, d=12, seed=1):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    out = []
    for i in range(n):
        v = centres[rng.integers(6)] + 0.6 * rng.normal(size=d)
        out.append((i, [float(x) for x in np.round(v / np.linalg.norm(v), 3)], int(rng.integers(4))))
    return out


@pytest.mark.parametrize("options", [{}, {"fit_rows": 300, "leaf_rows": 60}])
def test_negatives_are_exact(spark, monkeypatch, options):
    monkeypatch.setattr(negatives, "INDEX_BLOCK", 150)
    monkeypatch.setattr(negatives, "ANCHOR_BLOCK", 20)
    data = vectors(900)
    data += [(1000 + i, data[3][1], data[3][2]) for i in range(250)] + [(2000 + i, data[3][1], 9) for i in range(250)]  # crowds of copies
    df = spark.createDataFrame(schema="vec_id long, embedding array<float>, label int", data=data)
    data = [(i, [float(np.float32(x)) for x in v], l) for i, v, l in data]
    got = negatives.mine(df, df["vec_id"] % 50 == 0, **options)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == mined_by_definition(data, lambda i: i % 50 == 0)


def test_ranges_hold_every_score_and_eliminate():
    x = np.floor(256 * np.array([v for _, v, _ in vectors(3000, 6)]))
    tree = negatives.Tree.grow(x, 100)
    known = negatives.Ranges.empty(tree)
    known.add(tree, x[:1500])
    known.add(tree, x[1500:])
    least, most = known.scores(tree, x[:40])
    leaf, scores = tree.leaf_of(x), x[:40] @ x.T
    assert tree.leaves > 20 and len(np.unique(leaf)) == tree.leaves
    assert (scores >= least[:, leaf]).all() and (scores <= most[:, leaf]).all()
    tenth = np.sort(scores, axis=1)[:, -10]
    assert (most < tenth[:, None]).mean() > 0.3


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    good = vectors(120, 5)
    odd = [(500, None, 1), (501, [nan] * 5, 1), (502, [inf] * 5, 1), (503, [1.0, None, 0.0, 0.0, 0.0], 1), (504, [1.0] * 4, 1), (505, [], 1), (506, good[0][1], None), (None, good[0][1], 1), (507, [1e30] * 5, 1)]
    df = spark.createDataFrame(schema="vec_id long, embedding array<double>, label int, y string, leaf int", data=[(*r, "x", 0) for r in good + odd + good[:20]])
    got = negatives.mine(df, df["vec_id"] % 30 == 0, fit_rows=60, leaf_rows=20)
    assert sorted(map(tuple, got.collect())) == mined_by_definition(good, lambda i: i % 30 == 0)
    assert negatives.mine(df.limit(0), df["vec_id"] % 30 == 0).count() == 0
    assert negatives.mine(df, df["vec_id"] < 0).count() == 0


def test_products_stay_exact_beyond_doubles():
    x = np.array([[2.0**27 - 1] * 64])
    assert negatives.products(x, x)[0, 0] == 64 * (2**27 - 1) ** 2


# --- lexical search


def ranked_by_definition(docs, items, top=50):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    docs = [(i, words(t)) for i, t in docs if i is not None]
    n_docs, total = sum(bool(w) for _, w in docs), sum(len(w) for _, w in docs)
    df = {}
    for _, w in docs:
        for t in set(w):
            df[t] = df.get(t, 0) + 1
    wanted = {}
    for item, text in items:
        if item is not None:
            wanted.setdefault(item, set()).update(words(text))
    out = []
    for item, terms in wanted.items():
        scored = []
        for i, w in docs:
            if not w:
                continue
            m = 100 - 50 + (50 * len(w) * n_docs) // total
            score = 0
            for t in terms:
                tf = w.count(t)
                if tf:
                    score += floor(1000 * log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((1000000000 * tf) // (1000 * tf + 20 * m))
            if score > 0:
                scored.append((-score, i))
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def search_rows():
    rng = random.Random(2)
    vocabulary = ["stone", "river", "Über", "über", "ÉTÉ", "été", "x1", "9", "naïve", "İstanbul", "a b", "語", "the"]
    texts = [rng.choice([" ", ", ", "-", "_", "\n", "\x1c"]).join(rng.choice(vocabulary) for _ in range(rng.randint(0, 12))) for _ in range(150)]
    docs = [*enumerate(texts), (150, None), (151, ""), (152, "..."), (None, "stone"), (7, texts[7]), (153, "stone " * 4000 + "the"), (154, texts[3])]
    items = [(1, "stone Über 9"), (2, "river été naïve the"), (3, None), (4, "!!"), (None, "stone"), (5, "語 a b"), (2, "x1"), (6, "absent"), (1, "stone Über 9")]
    return docs, items


@pytest.mark.parametrize("block", [None, 2])
def test_ranking_is_exact(spark, monkeypatch, block):
    docs, items = search_rows()
    if block:
        monkeypatch.setattr(ranking, "BLOCK_ITEMS", block)
        monkeypatch.setattr(ranking, "CELLS", 64)
    d = spark.createDataFrame(schema="doc_id long, text string, score string", data=[(*r, "x") for r in docs]).repartition(5)
    i = spark.createDataFrame(schema="item_id long, text string, place string", data=[(*r, "x") for r in items])
    got = ranking.rank(d, i, top=20)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect())) == ranked_by_definition(docs, items, 20)
    assert ranking.rank(d.limit(0), i).count() == 0
    assert ranking.rank(d, i.limit(0)).count() == 0


def test_best_rows_keep_ties_by_the_smaller_id():
    best = ranking.Best(1, 3)
    best.add(np.array([9, 8]), np.array([[5], [5]]))
    best.add(np.array([7]), np.array([[5]]))
    best.result()
    best.add(np.array([1, 2]), np.array([[5], [4]]))
    assert [list(c) for c in best.result()] == [[0, 0, 0], [5, 5, 5], [1, 7, 8]]


@pytest.mark.parametrize("name", ["op12_hard_negatives", "op13_lexical_search"])
def test_queries_match_duckdb(spark, sf_dir, name):
    df = queries.QUERIES[name](spark, sf_dir)
    result = connect(sf_dir).execute(queries.ORACLE_SQL[name])
    assert rows(df.columns, df.collect()) == rows([d[0] for d in result.description], result.fetchall())
