"""The pipeline's stages against plain statements of what each must do to its input."""

import re

import corpus_pipeline
from tagmill.llm import pii


def test_stages_take_effect_one_after_another(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before, columns = {r["doc_id"]: r["text"] for r in docs.collect()}, docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [" ".join(r["text"].split()) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES:
        rows = stage(spark, docs, sf_dir).collect()
        ids = [r["doc_id"] for r in rows]
        assert len(ids) == len(set(ids)) and set(ids) <= set(before)
        if name == "quality":
            good = [i for i in before if labels.get(i) == 1]
            assert len(set(good) & set(ids)) >= 0.95 * len(good)
        if name == "near_duplicates":
            assert len({r["text"] for r in rows}) == len(rows)
        if name == "decontamination":
            assert set(ids) == {i for i, t in before.items() if not any(x in " ".join(t.split()) for x in items)}
        if name == "personal_data":
            assert set(ids) == set(before) and not any(pii.base_spans(r["text"]) for r in rows)
            assert all(r["n_chars"] == len(r["text"]) for r in rows)
        if name == "mixing":
            assert list(rows[0].asDict()) == [*columns, "topic", "n_tokens", "weight", "probability"]
            assert rows and all(r["text"] == before[r["doc_id"]] and r["n_chars"] == len(r["text"]) for r in rows)
            assert not any(pii.base_spans(r["text"]) for r in rows)
            assert len(rows) < len(before) and all(0 < r["probability"] <= 1 for r in rows)
        else:
            assert list(rows[0].asDict()) == columns
            docs = spark.createDataFrame(rows, docs.schema)
            before = {r["doc_id"]: r["text"] for r in rows}
    assert re.fullmatch(r"\w+", name)
