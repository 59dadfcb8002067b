"""The pipeline's near-duplicate stage against brute-force Jaccard similarity."""

import random

import corpus_pipeline
import numpy as np
from tagmill.llm import shingles, simhash
from tests.llm.test_operators import documents, groups, odd_texts, sampled


def plain_sets(texts):
    def one(text):
        words = (text or "").encode().lower().split()
        return frozenset(b" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()

    return {i: one(t) for i, t in texts}


def similar(a, b):
    return 10 * len(a & b) >= 8 * len(a | b)


def want(texts):
    sets = plain_sets(texts)
    linked = [(i, j) for i in sets for j in sets if i < j and similar(sets[i], sets[j])]
    name = groups(sets, linked)
    return {i: name[i] for i in sets}, linked


def edited(rng, words, changes):
    out = list(words)
    for at in rng.sample(range(len(out)), changes):
        out[at] = f"new{rng.randrange(10**6)}"
    return " ".join(out)


def planted():
    """Groups of copies with few changes, chains, a stock passage in all, and short texts."""
    rng = random.Random(11)
    stock = " ".join(f"stock{i}" for i in range(30))
    texts = []
    for g in range(8):
        base = [f"w{rng.randrange(500)}" for _ in range(120)]
        texts += [f"{edited(rng, base, k % 5)} {stock}" for k in range(12)]
        now = base
        for _ in range(5):
            now = edited(rng, now, 2).split()
            texts.append(" ".join(now))
    texts += ["a b c", "A  b c", "a b", "a b c d e", "a b c d e f", ""]
    return list(enumerate(texts, 1))


def test_stage_is_complete_and_exact(spark, sf_dir):
    for texts in (planted(), [(i, t) for i, t in sampled(spark, sf_dir) if i is not None]):
        name, linked = want(texts)
        assert linked
        found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(documents(spark, texts)).collect()}
        assert found == name


def test_stage_keeps_one_of_each_group(spark, sf_dir):
    texts = planted()
    name, _ = want(texts)
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts), sf_dir).collect()]
    assert sorted(kept) == sorted(set(name.values()))
    kept = [r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, odd_texts()), sf_dir).collect()]
    assert sorted(kept, key=str) == [1, 4, 5, None, None]
    assert shingles.near_duplicates(documents(spark, [])).count() == 0


def test_group_of_edited_copies_is_not_paired_all_with_all(spark, monkeypatch):
    rng = random.Random(5)
    base = [f"w{i}" for i in range(150)]
    texts = list(enumerate([edited(rng, base, rng.randrange(7)) for _ in range(400)], 1))
    name, _ = want(texts)
    verified, links, pairs, fingerprints = shingles._verified, shingles.simhash.links, [], []
    monkeypatch.setattr(shingles, "_verified", lambda p, *a: pairs.append(p.count()) or verified(p, *a))
    monkeypatch.setattr(shingles.simhash, "links", lambda f, *a: fingerprints.append(f.count()) or links(f, *a))
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(documents(spark, texts)).collect()}
    assert found == name and len(set(name.values())) > 100
    assert fingerprints[0] > 100
    assert sum(pairs) < 40 * len(texts)


def test_sketches_do_not_pass_the_driver(spark, monkeypatch):
    cut, plans = shingles.cut, []
    monkeypatch.setattr(shingles, "cut", lambda df: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or cut(df))
    texts = planted()
    name, _ = want(texts)
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(documents(spark, texts)).collect()}
    assert found == name
    compared = [p for p in plans if "a_q" in p]
    assert len(compared) == 3 and not any("strategy=broadcast" in p for p in compared)


def test_passes_that_find_nothing_cost_no_components(spark, monkeypatch):
    components, calls = shingles.components, []
    monkeypatch.setattr(shingles, "components", lambda links: calls.append(1) or components(links))
    found = {r["doc_id"]: r["component_id"] for r in shingles.near_duplicates(documents(spark, [(1, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f")])).collect()}
    assert found == {1: 1, 2: 2, 3: 1} and len(calls) == 1


def test_common_shingles_are_in_order(spark):
    texts = shingles._texts(documents(spark, [(i, f"one two three four five end{i}") for i in range(400)]), "doc_id", "text")
    common = shingles._common(texts, 5)
    assert common[:, 0].tolist() == shingles.shingles("one two three four five").tolist() and common[0, 1] >= shingles.SEEN
    assert shingles._common(texts.limit(0), 5).shape == (0, 2)


def test_stage_drops_what_the_simhash_operator_links(spark, sf_dir):
    rng = random.Random(23)
    base = [f"w{rng.randrange(4000)}" for _ in range(400)]
    # A word in each thirty changed: 0.73 of the five-word shingles are shared, and the fingerprints of some copies differ in three bits or fewer.
    texts = list(enumerate([" ".join(base), *[edited(rng, base, 13) for _ in range(120)]], 1))
    first = simhash.simhash(texts[0][1])
    near = [i for i, t in texts[1:] if (simhash.simhash(t) ^ first).bit_count() <= simhash.RADIUS]
    name, _ = want(texts)
    assert near and all(name[i] != 1 for i in near)
    kept = {r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, documents(spark, texts), sf_dir).collect()}
    assert not kept & set(near)
    by_operator = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(documents(spark, texts)).collect()}
    # A group is what links of both kinds reach, and its smallest id stays.
    linked = [(i, j) for i in name for j in name if i < j and (name[i] == name[j] or by_operator[i] == by_operator[j])]
    assert kept == set(groups(dict(texts), linked).values())


def test_exploded_prefixes_are_not_broadcast(spark, monkeypatch):
    cut, plans = shingles.cut, []
    monkeypatch.setattr(shingles, "cut", lambda df: plans.append(df._jdf.queryExecution().sparkPlan().toString()) or cut(df))
    texts = shingles._texts(documents(spark, [(1, "a b c d e f"), (2, "g h i j k l"), (3, "a b c d e f g")]), "doc_id", "text")
    found = shingles._postings(shingles._sets(texts, np.empty((0, 2), np.int64), 8, 5))
    assert found.count() == 2
    assert any("posexplode" in p for p in plans) and not any("Broadcast" in p for p in plans)
