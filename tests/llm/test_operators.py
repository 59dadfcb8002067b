"""Each corpus operator against a plain version, and on null, empty, long, repeated and clashing rows."""

import hashlib
import html
import os
import random
import re
import time

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tagmill.llm import leaks, licenses, mixing, neighbours, pages, pii, quality, queries, shingles, simhash, suffixes, tokens
from tagmill.llm.common import BATCH_BYTES
from tagmill.llm.components import components
from tests.oracle import rows as plain_rows

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, id string, kind string, h long"


def documents(spark, texts):
    """Texts as a table with columns whose names the operators use inside."""
    return spark.createDataFrame([(i, t, "en", "s", 0, "x", "y", "z", 1) for i, t in texts], SCHEMA)


def odd_texts():
    rng = random.Random(3)
    words = ["alpha", "beta", "Gamma", "delta,", "é", "x1"]
    long = " ".join(rng.choice(words) for _ in range(30_000))
    return [(1, None), (2, ""), (3, "  \n"), (4, "one two"), (5, long), (6, long), (6, long), (7, "one two"), (None, "null id"), (None, None)]


def sampled(spark, sf_dir):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]


# --- near duplicates -------------------------------------------------------------------------------------------------


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [simhash.xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(values, linked):
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for a, b in linked:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {v: find(v) for v in values}


def test_simhash_matches_brute_force(spark, sf_dir):
    texts = sampled(spark, sf_dir)[:120] + odd_texts()
    found = simhash.near_duplicates(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    prints = [(i, plain_simhash(t)) for i, t in texts]
    assert sorted((r["doc_id"] or -1, r["fp"] % (1 << 64)) for r in found) == sorted((i or -1, f) for i, f in prints)
    values = sorted({f for _, f in prints})
    name = groups(values, [(a, b) for a in values for b in values if a < b and (a ^ b).bit_count() <= 3])
    least = {}
    for i, f in prints:
        if i is not None:
            least[name[f]] = min(i, least.get(name[f], i))
    assert all(r["component_id"] == least.get(name[r["fp"] % (1 << 64)]) for r in found)


def test_links_are_complete(spark):
    rng = random.Random(4)
    values = {0, (1 << 63) - 1}
    for _ in range(60):
        base = rng.getrandbits(64)
        for _ in range(4):
            values.add(base ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4))))
    signed = [simhash._signed(v) for v in values]
    found = {(r["a"], r["b"]) for r in simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long")).collect()}
    mask = (1 << 64) - 1
    assert found == {(a, b) for a in signed for b in signed if a < b and ((a ^ b) & mask).bit_count() <= 3}


def test_rows_that_meet_are_shuffled_at_any_size(spark):
    # Twenty rows of some 170 bytes stand for each fingerprint, which Spark takes for one of a few bytes.
    fps = spark.range(1000).select(F.xxhash64("id").alias("fp"))
    plan = simhash.links(fps)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_keep_one_and_empty_table(spark):
    kept = [r["doc_id"] for r in simhash.keep_one(documents(spark, odd_texts())).collect()]
    assert sorted(kept, key=str) == [1, 4, 5, None, None]
    assert simhash.near_duplicates(documents(spark, [])).count() == 0


def test_components_of_chain_star_and_repeats(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(100, 101), (7, 7), (None, 3)]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}


# --- repeated strings ------------------------------------------------------------------------------------------------


def plain_repeats(texts):
    seen, out = set(), {}
    for i, text in sorted({(-1 if i is None else i, t or "") for i, t in texts}):
        raw = text.encode()
        gone = bytearray(len(raw))
        for s in range(len(raw) - 99):
            if (k := raw[s : s + 100]) in seen:
                gone[s : s + 100] = b"\1" * 100
            seen.add(k)
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        spans = sum(g and not p for p, g in zip(b"\0" + gone, gone))
        out[i, text] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("part", [suffixes.PART, 2])
def test_repeats_match_brute_force(spark, monkeypatch, part):
    monkeypatch.setattr(suffixes, "PART", part)  # two contexts: nearly every anchor is split
    rng = random.Random(5)
    words = ["alpha", "beta", "gamma", "delta", "eps", "é"]
    parts = [" ".join(rng.choice(words) for _ in range(rng.choice([5, 40, 90]))) for _ in range(9)]
    texts = [(i, "".join(rng.choice(parts)[rng.randint(0, 40) :] for _ in range(rng.randint(0, 3)))) for i in range(40)]
    texts += [(50, "x" * 350), (51, "x" * 99), (52, None), (53, ""), (None, parts[1]), (54, parts[1]), (54, parts[1])]
    want = plain_repeats(texts)
    found = suffixes.without_repeats(documents(spark, texts)).collect()
    assert len(found) == len(texts)
    left = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in found)
    assert left == sorted((-1 if i is None else i, *want[-1 if i is None else i, t or ""]) for i, t in texts)
    assert suffixes.without_repeats(documents(spark, [])).count() == 0


def test_multikey_order_sorts():
    rng = np.random.default_rng(1)
    words = rng.integers(0, 3, (9_000, 4)).astype(np.uint64)
    at = suffixes.multikey_order(words)
    assert (words[at] == words[np.lexsort(words.T[::-1])]).all()


# --- tokens ----------------------------------------------------------------------------------------------------------


def test_token_counts_match_the_library(spark, sf_dir):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(tokens.default_vocabulary())
    rng = random.Random(6)
    letters = "  \n\t\x1c\x85 ​ab'sté日本123½!?#🙂́aaaa"
    texts = sampled(spark, sf_dir)[:60] + odd_texts()
    texts += [(100 + i, "".join(rng.choice(letters) for _ in range(40)) + rng.choice(["", "<|endoftext|>", " <|endoftext|> x"])) for i in range(150)]
    texts += [(900, "a" * 9_000), (901, "".join(rng.choice("abcdefgh") for _ in range(9_000)))]
    found = tokens.token_counts(documents(spark, texts), tokens.default_vocabulary()).collect()
    want = [(i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in texts]
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in found), key=str) == sorted(want, key=str)
    assert all(r["over_limit"] == (r["n_tokens"] > 512) for r in found)


# --- personal data ---------------------------------------------------------------------------------------------------

BASE = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and pii.luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span(), True))
    return out


def test_base_spans_match_plain_patterns():
    rng = random.Random(7)
    parts = ["a@", "b.c", "@", "%x", "1.2", "3.4.", "255.", "256", "0", "01", " ", "-", "+", "4111 1111 1111 1111", "(5", "é", ".", "com", "\n"]
    for _ in range(4_000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_spans(text), text


def test_pii_rows_added_spans_and_masks(spark):
    texts = odd_texts() + [(20, "mail a.b@c.org or call (743) 555-3824, ip 10.0.0.1"), (21, "phone 743 555 3824"), (22, "4111111111111111")] + [(30 + i, f"tel +1 (743) 555-38{i}") for i in range(10, 40)]
    docs = documents(spark, texts)
    model = pii.learn(docs)
    found = {r["doc_id"]: r for r in pii.find(docs, model).where("doc_id is not null").collect()}
    for i, t in texts:
        if i is not None:
            base = plain_spans(t or "")
            assert found[i]["base_sha256"] == hashlib.sha256(pii.joined(base).encode()).hexdigest()
            assert set(pii.joined(base).split(",")) - {""} <= set(found[i]["spans"].split(","))
    assert found[20]["spans"] == "email:5:14,ip:42:50,phone:23:37"
    assert {r["doc_id"]: r["text"] for r in pii.masked(docs, model).where("doc_id in (1, 20)").collect()} == {1: None, 20: "mail <email> or call <phone>, ip <ip>"}
    assert pii.find(documents(spark, []), pii.learn(documents(spark, []))).count() == 0


def test_estimate_tells_reliable_labelers():
    counts = {(1, 1, 0): 80, (1, 0, 0): 10, (-1, -1, 1): 60, (-1, -1, 0): 40}
    p = pii.estimate(counts)
    assert p[1, 1, 0] > 0.9 and p[-1, -1, 1] < 0.1


# --- licences --------------------------------------------------------------------------------------------------------


def plain_licence(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    at = [(i, label) for phrase, label in licenses.PHRASES.items() for i in range(len(words)) if words[i : i + len(phrase.split())] == phrase.split()]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({x for _, x in at}))


def test_licence_base_and_labels(spark, sf_dir):
    texts = sampled(spark, sf_dir) + [(i if i is None else 10_000 + i, t) for i, t in odd_texts()]
    texts += [(20_000, "CC BY-NC 4.0; cc by cc"), (20_001, "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"), (20_002, "the MIT"), (20_003, "cc")]
    found = licenses.scan(documents(spark, texts)).collect()
    assert sorted(((r["doc_id"], r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for r in found), key=str) == sorted(((i, *plain_licence(t)) for i, t in texts), key=str)
    by_id = {r["doc_id"]: r for r in found}
    assert by_id[20_001]["labels"] == "mit" and by_id[20_001]["base_labels"] == "" and by_id[20_001]["score"] == 1.0
    assert by_id[20_002]["labels"] == "" and by_id[20_002]["score"] == 0.0
    assert all(set(r["base_labels"].split(",")) - {""} <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1 for r in found)
    assert licenses.scan(documents(spark, [])).count() == 0


# --- decontamination -------------------------------------------------------------------------------------------------

ITEM = "A train leaves with 12 cars and Anna counts 30 km of track before the next 12 bridges appear near the river"


def test_leaks_carry_hashes_of_windows_and_no_words(spark, monkeypatch):
    text = "the quick brown fox jumps over the lazy dog and runs away from the farm"
    docs = spark.createDataFrame([(1, f"before {text} after"), (2, "nothing of that kind is said in here at all"), (3, f"x {text}"), (3, f"x {text}"), (3, f"other words before {text}")], "doc_id long, text string")
    items = spark.createDataFrame([(7, text), (8, text)], "item_id long, text string")
    cut, tables = leaks.cut, []
    monkeypatch.setattr(leaks, "cut", lambda df: tables.append(cut(df)) or tables[-1])
    found = leaks.find(docs, items)
    exploded = [line for line in found._jdf.queryExecution().sparkPlan().toString().split("\n") if "pos#" in line and "Generate" in line]
    assert not exploded  # the windows' part of the job is over: what follows reads the alignments found
    shifts = next(t for t in tables if "shift" in t.columns)
    assert {kind for name, kind in shifts.dtypes if name != "doc_id"} == {"bigint", "int"} and {r["doc_id"] for r in shifts.collect()} == {1, 3}
    rows = sorted((r["doc_id"], r["item_id"], r["n_windows"], r["n_matched"], r["kind"]) for r in found.collect())
    assert rows == [(d, i, 11, 11, "verbatim") for d in (1, 3) for i in (7, 8)]
    plan = leaks.without_leaks(docs, items)._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan  # no text is shuffled
    assert [r["doc_id"] for r in leaks.without_leaks(docs, items).collect()] == [2]
    # Beyond the bound, sides are shuffled, whatever size the planner takes them for.
    import tagmill.llm.common as common

    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    shuffled = leaks.find(docs, items)
    assert "Broadcast" not in shuffled._jdf.queryExecution().sparkPlan().toString()
    assert sorted((r["doc_id"], r["item_id"], r["n_windows"], r["n_matched"], r["kind"]) for r in shuffled.collect()) == rows


def test_leaks_verbatim_reparameterised_and_inconsistent(spark):
    new = ITEM.replace("12", "47").replace("Anna", "Bertha").replace("30 km", "9 mi")
    texts = odd_texts() + [(20, f"Before that {ITEM} and more."), (21, f"so it was: {new}"), (22, ITEM.replace("12 bridges", "13 bridges")), (23, "A train leaves with 12 cars")]
    items = spark.createDataFrame([(5, ITEM), (5, ITEM), (6, "too short"), (7, None), (None, ITEM)], "item_id long, text string")
    found = {r["doc_id"]: r for r in leaks.find(documents(spark, texts), items).collect()}
    assert set(found) == {20, 21}
    assert (found[20]["kind"], found[21]["kind"], found[21]["n_changed"]) == ("verbatim", "reparameterised", found[21]["n_slots"])
    clean = leaks.without_leaks(documents(spark, texts), items)
    assert clean.count() == len(texts) - 2
    assert leaks.find(documents(spark, []), items).count() == 0


def test_leaks_find_every_whole_passage_and_nothing_else(spark, sf_dir):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(i, k) for i, t in sampled(spark, sf_dir) for k, x in items if " ".join(x.split()) in " ".join(t.split())}
    found = {(r["doc_id"], r["item_id"]) for r in queries.op2_decontamination(spark, sf_dir).collect()}
    assert found == want and want


# --- quality ---------------------------------------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark, sf_dir):
    sf_dir = sf_dir.replace("sf0.001", "sf0.01")
    scored = queries.op5_quality(spark, sf_dir).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    assert np.mean([r["predicted"] == r["quality"] for r in scored]) > 0.9
    assert all((r["predicted"] == 1) == (r["score"] >= 0.3) for r in scored)


def test_quality_of_odd_rows_and_missing_labels(spark):
    docs = documents(spark, odd_texts())
    none = spark.createDataFrame([(1, None), (None, 1), (2, 5)], "doc_id long, quality int")
    scored = quality.score(docs, quality.fit(docs, none)).collect()
    assert len(scored) == len(odd_texts()) and {r["quality_score"] for r in scored} == {0.5}
    assert quality.score(documents(spark, []), quality.fit(documents(spark, []), none)).count() == 0


def test_python_workers_take_texts_by_bytes(spark):
    bound = "spark.sql.execution.arrow.maxBytesPerBatch"
    docs = documents(spark, [(i, "word " * 10_000) for i in range(100)]).coalesce(1)
    untrained = quality.Model(np.zeros(quality.DIMS), 1.0, 0.0)
    sizes = F.pandas_udf(lambda texts: texts.str.len() * 0 + texts.str.len().sum(), "long")
    try:
        for use in (lambda: quality.score(docs, untrained), lambda: quality.fit(docs, docs.selectExpr("doc_id", "1 quality")), lambda: pii.masked(docs, {}), lambda: shingles.keep_one(docs)):
            spark.conf.unset(bound)
            use()
            taken = docs.select("text").mapInPandas(lambda batches: (b["text"].str.len().agg(["sum"]).to_frame("n") for b in batches), "n long")
            assert max(r["n"] for r in taken.collect()) <= 2 * BATCH_BYTES
            assert max(r["n"] for r in docs.select(sizes("text").alias("n")).collect()) <= 2 * BATCH_BYTES
        spark.conf.set(bound, "12345678")  # a session's own bound stands
        quality.score(docs, untrained)
        assert "12345678" in spark.conf.get(bound)
    finally:
        spark.conf.unset(bound)


# --- neighbours ------------------------------------------------------------------------------------------------------


def test_search_recall_ties_and_unusable_vectors(spark):
    rng = np.random.default_rng(8)
    x = rng.normal(size=(3_000, 16)) + 3 * rng.normal(size=(12, 16))[rng.integers(0, 12, 3_000)]
    x[40] = x[41] = x[60]
    table = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(9_000, None), (9_020, [0.0] * 16), (9_040, [float("nan")] * 16), (9_060, [None] * 16), (None, [1.0] * 16)]
    df = spark.createDataFrame(table + bad + table[:3], "vec_id long, embedding array<double>")
    found = neighbours.search(df, df.where("vec_id % 20 = 0"), k=20).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 3_000, 20)) and all(len(v) == 20 for v in got.values())
    hits = 0
    for q, near in got.items():
        s = x @ x[q]
        assert all(abs(s[i] - score) < 1e-9 for i, score in near) and q not in [i for i, _ in near]
        assert near == sorted(near, key=lambda p: (-p[1], p[0]))
        hits += len({i for i, _ in near} & {i for i in np.lexsort((np.arange(3_000), -s)) if i != q and s[i] >= np.sort(np.delete(s, q))[-20]})
    assert hits / (20 * len(got)) >= 0.9
    empty = df.where("false")
    assert neighbours.search(empty, empty).count() == 0


# --- pages -----------------------------------------------------------------------------------------------------------


def test_shared_lines_are_a_longest_common_subsequence():
    rng = random.Random(9)
    for _ in range(400):
        a, b = ([rng.randint(0, 5) for _ in range(rng.randint(0, 14))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(pages.shared_lines(a, b))
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[i] in rest for i in found), (a, b, found)


def test_page_text_by_differencing(spark):
    page = "<html><body><div>Site name</div><div><p>{0}  &amp; more</p><p>second {0}</p></div><div>Copyright us</div><script>x</script></body></html>"
    marked = "<body><nav><a>Home</a></nav><article><h1>T</h1><p>a<b>b</b>c<br>d</p><div class='comments'>hi</div></article><aside>x</aside><form>f</form></body>"
    rows = [(i, f"http://h.org/a/{i}", page.format(f"text {i}"), 1) for i in range(6)] + [(9, None, None, 1), (10, "nonsense", marked, 1), (11, "http://h.org/a/0", page.format("text 0"), 1), (11, "http://h.org/a/0", page.format("text 0"), 1), (None, "http://lone.org/", page.format("lone"), 1)]
    found = pages.main_text(spark.createDataFrame(rows, "page_id long, url string, html string, text int")).collect()
    assert len(found) == len(rows)
    text = {r["page_id"]: r["text"] for r in found}
    assert text[3] == "text 3 & more\nsecond text 3"
    assert text[9] == "" and text[10] == "T\nabc\nd"
    assert text[None] == "Site name\nlone & more\nsecond lone\nCopyright us"
    assert all(r["n_chars"] == len(r["text"]) for r in found)
    assert pages.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_page_text_of_given_pages(spark, sf_dir):
    given = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{sf_dir}/pages.parquet").collect()}
    for r in queries.op1_page_text(spark, sf_dir).collect():
        body = re.search(r"<article>(.*)</article>", given[r["page_id"]], re.S).group(1)
        lines = (re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", "", x))).strip() for x in re.split(r"</?(?:p|h1|br)>", body))
        assert r["text"] == "\n".join(x for x in lines if x)


# --- mixing ----------------------------------------------------------------------------------------------------------


def test_mixing_matches_duckdb(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    want = con.execute(queries.ORACLE_SQL["op10_mixing"])
    names = [d[0] for d in want.description]
    found = queries.op10_mixing(spark, sf_dir)
    assert plain_rows(found.columns, found.collect()) == plain_rows(names, want.fetchall())


def test_mixing_meets_targets_and_odd_rows(spark):
    rows = [(i, "w " * (1 + i % 7), "en" if i % 3 else "de", "hot" if i % 10 else "cold") for i in range(600)] + [(None, None, None, None), (1, "", "en", "hot")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    _, cells = mixing.calibrated(docs, {"source": {"hot": 0.5, "cold": 0.5, "gone": 1.0}}, sweeps=20)
    table = cells.collect()
    share = {s: sum(r["w"] for r in table if r["source"] == s) for s in ("hot", "cold", "unknown")}
    assert share["hot"] == pytest.approx(share["cold"], rel=1e-3) and share["unknown"] == 0
    assert all(0 <= r["p"] <= 1 for r in table)
    # The scarce source is taken whole, and the sample is twice as large as it.
    cold = sum(r["tokens"] for r in table if r["source"] == "cold")
    assert sum(r["p"] * r["tokens"] for r in table) == pytest.approx(2 * cold, rel=0.01)
    assert mixing.sample(docs.where("false")).count() == 0


def test_mixing_sample_meets_every_feasible_margin(spark, sf_dir):
    # Enough documents for the sweeps to converge; 200 documents leave cells too few for that.
    docs = spark.read.parquet(f"{os.path.dirname(sf_dir)}/sf0.01/documents.parquet")
    table = mixing.margins(docs).collect()
    assert {r["margin"] for r in table} == set(mixing.MARGINS)
    assert all(r["feasible"] for r in table) and all(r["reached"] == pytest.approx(r["share"], rel=0.01) for r in table)
    # A source too scarce for its target even in the smallest sample is taken whole and reported.
    rows = [(i, "w w w", "en" if i % 2 else "de", "rare" if i == 7 else "a" if i % 3 else "b") for i in range(900)]
    few = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    table = {r["value"]: r for r in mixing.margins(few, {"source": {"rare": 0.4, "a": 0.3, "b": 0.3}}).collect()}
    assert not table["rare"]["feasible"] and table["rare"]["reached"] == pytest.approx(1 / 90, rel=0.01)
    assert table["a"]["feasible"] and table["a"]["reached"] == pytest.approx(table["b"]["reached"], rel=0.01)


LONG = "In the yard stand 3 carts and 4 barrels beside the old stone wall while the keeper of the gate writes a short report about the weather and the state of the road for the council of the town"
HEAVY = "Convert 12 km 300 m and 5 kg 20 g"
NAMES = "On most days when Anna meets Bertha near the bridge they walk with Carla towards the market square"


def test_leaks_of_one_changed_number_and_of_numbers_become_equal(spark):
    equal = LONG.replace("3 carts", "5 carts").replace("4 barrels", "5 barrels")
    once = LONG.replace("4 barrels", "3 barrels") + " with 3 lamps"
    texts = [(1, equal), (2, once.replace("3 lamps", "9 lamps")), (3, LONG)]
    items = spark.createDataFrame([(1, LONG), (2, once)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in leaks.find(documents(spark, texts), items).collect()}
    assert {(1, 1), (2, 2), (3, 1)} <= set(found)
    assert found[3, 1]["similarity"] == 1.0 and found[3, 1]["kind"] == "verbatim"
    assert 0.8 <= found[1, 1]["similarity"] < 1 and found[2, 2]["n_matched"] < found[2, 2]["n_windows"]


def test_leaks_of_placeholder_heavy_items_and_other_case_or_layout(spark):
    texts = [(1, f"please: {HEAVY} now"), (2, HEAVY.replace("12", "14").replace("300", "250")), (3, NAMES.lower()), (4, NAMES.upper()), (5, NAMES.replace(" ", "\n")), (6, "1 km 2 m and then 3 kg or 4 g")]
    items = spark.createDataFrame([(1, HEAVY), (2, NAMES)], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]): r for r in leaks.find(documents(spark, texts), items).collect()}
    assert set(found) == {(1, 1), (2, 1), (3, 2), (4, 2), (5, 2)}
    assert all(r["similarity"] == 1.0 for r in found.values())
    assert {k: r["kind"] for k, r in found.items()} == {k: "reparameterised" if k == (2, 1) else "verbatim" for k in found}


def test_licence_scan_finds_every_notice_of_a_file(spark):
    wanted = [t for t in licenses.TEMPLATES if t.label in ("lgpl", "bsd", "isc", "mpl", "unlicense", "cc0", "cc-by-nc", "agpl")]
    prose = "The compliance office took charge of each person who wrote about mozilla and the affero foundation, lesser commons and binary forms. "
    texts = [(1, ".\n".join(t.text for t in wanted)), (2, prose * 50 + "Subject to the terms of the Mozilla Public License"), (3, prose)]
    found = {r["doc_id"]: r["labels"] for r in licenses.scan(documents(spark, texts)).collect()}
    assert set(found[1].split(",")) >= {t.label for t in wanted} and found[2] == "mpl" and found[3] == ""


def test_licence_scan_of_a_long_text_takes_time_in_its_words(spark):
    known = spark.createDataFrame([(1, "licensed under cc by " * 25_000), (2, "by under public licensed " * 25_000)], "doc_id long, text string")
    start = time.perf_counter()
    found = {r["doc_id"]: r for r in licenses.scan(known).collect()}
    assert time.perf_counter() - start < 60
    assert found[1]["n_words"] == found[2]["n_words"] == 100_000
    assert (found[1]["n_base"], found[1]["first_word"], found[1]["last_word"], found[1]["labels"]) == (25_000, 2, 99_998, "cc-by")
    assert found[2]["n_base"] == 0 and found[2]["labels"] == ""


def test_page_wrappers_named_like_menus_keep_their_article():
    article = "<article><header class='entry-header'><h1>T</h1></header><p>text</p><div class='comments'><article>reply</article></div></article>"
    for name in ("layout has-sidebar", "no-sidebar content", "content-with-menu", "navbar-fixed page", "sidebar", "menu page"):
        page = f"<body><div class='{name}'><p>aside</p><div class='ad'>buy</div>{article}</div><div class='sidebar'>side</div></body>"
        assert [(t, s) for t, s in pages.lines_of(page) if s != pages.DROP] == [("aside", pages.FREE), ("T", pages.KEEP), ("text", pages.KEEP)], name
    assert pages.lines_of("<div class='site-header'>x</div><div id='cookie-banner'>y</div>") == [("x", pages.DROP), ("y", pages.DROP)]
