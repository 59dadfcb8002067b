"""Export, splits, labels, evaluation and batch scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from tagmill.functions.text import base64_text
from tagmill.operators import evaluate, export, images, labels, model
from tagmill.operators import tags as tag_ops
from tagmill.plans import fixtures
from tagmill.plans.fixtures import SCORES_SQL, derive, in_duckdb, scores, table
from tagmill.plans.registry.tag_queries import ITEMS_CTE
from tagmill.schemas import WIDE_TAGS
from tagmill.session import scratch_path

K = 5


def _rated(spark, sf_dir):
    """Rated documents in dataset form; the text stands for the image bytes."""
    return derive(spark, sf_dir, fixtures.RATED).select(
        "id", "image", "is_nsfw", "is_nsfl", "is_nsfp", F.array("lang", "source").alias("tags"),
        F.array("weight", F.lit(0.5)).alias("confidences"), F.col("text").cast("binary").alias("image_data"),
    )


RATED_CTE = f"""WITH rated AS ({in_duckdb(fixtures.RATED)}),
hashed AS (SELECT *, ('0x' || substr(md5(CAST(id AS varchar)), 1, 8))::bigint AS h FROM rated),
split AS (SELECT *, CASE WHEN h % 10000 < 1000 THEN 'test' ELSE 'train' END AS split FROM hashed),
safe AS (SELECT * FROM split WHERE NOT (is_nsfw OR is_nsfl OR is_nsfp))
"""
_RESULT = "id, image, split, lang || '|' || source AS tags, round(weight, 6) AS first_confidence, length(to_base64(encode(text))) AS b64_length, md5(to_base64(encode(text))) AS b64_md5"


def _shown(df):
    b64 = F.col("image_bytes_b64")
    return df.select(
        "id", "image", "split", F.array_join("tags", "|").alias("tags"), F.round(F.get("confidences", F.lit(0)), 6).alias("first_confidence"),
        F.length(b64).alias("b64_length"), F.md5(b64.cast("binary")).alias("b64_md5"),
    )


def export_safe(spark, sf_dir):
    return _shown(export.with_split(export.export_columns(export.safe_only(_rated(spark, sf_dir)))))


def sample_cap(spark, sf_dir):
    safe = export.safe_only(_rated(spark, sf_dir))
    return _shown(export.with_split(export.export_columns(export.sample_cap(safe, 100))))


def train_test_split(spark, sf_dir):
    """80/20 split of all items, by id."""
    return export.with_split(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id")), 0.2)


def dataset_card_stats(spark, sf_dir):
    return export.card_stats(_rated(spark, sf_dir)).withColumn("safe_percent", F.round("safe_percent", 6))


def base64_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    b64 = base64_text(F.col("text").cast("binary"))
    return docs.select("doc_id", F.length(b64).alias("b64_length"), F.md5(b64.cast("binary")).alias("b64_md5"))


def _item_tags(spark, sf_dir):
    """Normalised tags of all items, one row per (item, tag occurrence)."""
    items = fixtures.stored_items(spark, sf_dir).select("id", "image", "tags_data").where("tags_data IS NOT NULL")
    return tag_ops.explode_tags(tag_ops.parse_tags(items)).select("id", "tag")


_TAGS_CTE = f"""WITH {ITEMS_CTE},
it AS (SELECT id, trim(lower(t.tag), E' \\t\\n\\r\\f\\v') AS tag FROM (SELECT id, unnest(tags) AS t FROM parsed) u),
vocab AS (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS idx FROM (SELECT DISTINCT tag FROM it) d)
"""


def tag_vocab(spark, sf_dir):
    return labels.vocabulary(_item_tags(spark, sf_dir))


def encode_labels(spark, sf_dir):
    tags = _item_tags(spark, sf_dir)
    counts = labels.frequencies(tags)
    return labels.encode_labels(tags, labels.vocabulary(counts), counts)


def decode_labels(spark, sf_dir):
    tags = _item_tags(spark, sf_dir)
    counts = labels.frequencies(tags)
    vocab = labels.vocabulary(counts)
    return labels.decode_labels(labels.encode_labels(tags, vocab, counts), vocab, counts).groupBy("tag").agg(F.count("*").alias("n_items"))


def csv_wide_tags(spark, sf_dir):
    """Wide tag columns written as CSV, read back with their schema and unpivoted."""
    items = fixtures.stored_items(spark, sf_dir).select("id", "image", "tags_data").where("tags_data IS NOT NULL")
    listed = tag_ops.with_occurrences(tag_ops.parse_tags(items)).select("image", F.transform("occ", lambda o: o["tag"]).alias("tags"))
    path = scratch_path(spark, "wide")
    labels.to_wide(listed).write.option("header", True).csv(path)
    return labels.from_wide(spark.read.schema(WIDE_TAGS).option("header", True).csv(path))


def _truth(spark, sf_dir):
    return scores(spark, sf_dir).where("is_true = 1").select("sample_id", "class_idx")


def _scores(spark, sf_dir):
    return scores(spark, sf_dir).select("sample_id", "class_idx", "score")


def _class_vocab(spark, sf_dir):
    """Names for the classes: a class is called after its position."""
    classes = _scores(spark, sf_dir).select("class_idx").distinct()
    return classes.select(F.col("class_idx").alias("idx"), F.concat(F.lit("class "), F.col("class_idx")).alias("tag"))


def eval_prf(spark, sf_dir):
    row = evaluate.precision_recall_f1(_scores(spark, sf_dir), _truth(spark, sf_dir))
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def eval_hamming(spark, sf_dir):
    return evaluate.hamming_accuracy(_scores(spark, sf_dir), _truth(spark, sf_dir)).select(F.round("hamming_accuracy", 6).alias("hamming_accuracy"))


def eval_topk(spark, sf_dir):
    row = evaluate.top_k_accuracy(_scores(spark, sf_dir), _truth(spark, sf_dir), K)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def eval_map(spark, sf_dir):
    row = evaluate.mean_average_precision(_scores(spark, sf_dir), _truth(spark, sf_dir), K)
    return row.select(F.round("mean_average_precision", 6).alias("mean_average_precision"))


def eval_all(spark, sf_dir):
    row = evaluate.metrics(_scores(spark, sf_dir), _truth(spark, sf_dir), K)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def top_k_classes(spark, sf_dir):
    return evaluate.top_k(_scores(spark, sf_dir), K).select("sample_id", "class_idx", "rank", F.round("score", 6).alias("score"))


def sample_predictions(spark, sf_dir):
    return evaluate.sample_predictions(_scores(spark, sf_dir), _truth(spark, sf_dir), _class_vocab(spark, sf_dir), K)


def _eval_cte(scored: str, k: int = K) -> str:
    """Metrics of a relation (sample_id, class_idx, score, is_true)."""
    return f"""scores AS ({scored}),
per AS (SELECT sample_id, count(*) FILTER (score > 0.5 AND is_true = 1) AS tp, count(*) FILTER (score > 0.5 AND is_true = 0) AS fp,
               count(*) FILTER (score <= 0.5 AND is_true = 1) AS fn FROM scores GROUP BY sample_id),
pr AS (SELECT avg(tp / (tp + fp + 1e-10)) AS p, avg(tp / (tp + fn + 1e-10)) AS r FROM per),
ham AS (SELECT avg(CASE WHEN (score > 0.5) = (is_true = 1) THEN 1.0::double ELSE 0 END) AS h FROM scores),
ranked AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY score DESC, class_idx) AS rank FROM scores),
best AS (SELECT * FROM ranked WHERE rank <= {k}),
topk AS (SELECT avg(hit) AS acc FROM (SELECT sample_id, max(is_true) AS hit FROM best GROUP BY sample_id) t),
ap AS (SELECT b.sample_id, sum(CASE WHEN is_true = 1 THEN hits / rank ELSE 0 END) / least(max(n_true), {k}) AS ap
       FROM (SELECT *, sum(is_true) OVER (PARTITION BY sample_id ORDER BY rank) AS hits FROM best) b
       JOIN (SELECT sample_id, sum(is_true) AS n_true FROM scores GROUP BY sample_id) n ON b.sample_id = n.sample_id
       WHERE n_true > 0 GROUP BY b.sample_id),
map AS (SELECT avg(ap) AS m FROM ap)
"""


_EVAL_CTE = "WITH " + _eval_cte(SCORES_SQL)


def _all_metrics(k: int) -> str:
    return f"""SELECT round(p, 6) AS "precision", round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-10), 6) AS f1_score, round(h, 6) AS hamming_accuracy,
              round(acc, 6) AS top_{k}_accuracy, round(m, 6) AS mean_average_precision FROM pr, ham, topk, map"""


def _features(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("embedding").alias("features"))


def _class_labels(spark, sf_dir):
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), F.col("label").cast("long").alias("class_idx"))


def _named(spark, sf_dir):
    features, classes = _features(spark, sf_dir), _class_labels(spark, sf_dir)
    vocab = classes.select(F.col("class_idx").alias("idx"), F.concat(F.lit("label "), F.col("class_idx")).alias("tag")).distinct()
    return model.name_predictions(model.predict_top_k(features, model.class_centroids(features, classes), K), vocab)


def predict_topk(spark, sf_dir):
    return _named(spark, sf_dir).withColumn("confidence", F.round("confidence", 6))


def predictions_json(spark, sf_dir):
    """One JSON text per image with its best tags."""
    samples = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("sample_id"), F.concat(F.lit("img/"), F.col("vec_id"), F.lit(".png")).alias("image"))
    records = model.prediction_records(_named(spark, sf_dir), samples, K)
    text = F.to_json(F.struct("image", "tags"))
    return records.select(
        "image", F.get_json_object(text, "$.tags[0].tag").alias("best_tag"),
        F.round(F.get_json_object(text, "$.tags[0].confidence").cast("double"), 6).alias("best_confidence"),
        F.json_array_length(F.get_json_object(text, "$.tags")).alias("n_tags"),
    )


_PREDICT_CTE = f"""WITH cells AS (SELECT vec_id, label, d, CAST(embedding[d + 1] AS double) AS x FROM (SELECT vec_id, label, embedding, unnest(range(len(embedding))) AS d FROM embeddings) e),
w AS (SELECT label, d, avg(x) AS w FROM cells GROUP BY label, d),
z AS (SELECT c.vec_id AS sample_id, w.label AS class_idx, 1 / (1 + exp(-sum(c.x * w.w))) AS confidence FROM cells c JOIN w ON c.d = w.d GROUP BY 1, 2),
best AS (SELECT *, row_number() OVER (PARTITION BY sample_id ORDER BY confidence DESC, class_idx) AS rank FROM z)
"""


#: Steps of the registered fits; their SQL unrolls them.
STEPS, SHRINK = 6, 0.01


def fit_weights(spark, sf_dir):
    """All weights of a model fitted for all classes, one row each; the intercept is the last position."""
    fitted = model.fit(_features(spark, sf_dir), _class_labels(spark, sf_dir), iterations=STEPS, regularisation=SHRINK)
    return fitted.select("class_idx", F.posexplode(F.concat("coef", F.array("intercept"))).alias("position", "weight")).select("class_idx", F.col("position").cast("long").alias("position"), F.round("weight", 6).alias("weight"))


def fit_accuracy(spark, sf_dir):
    """Metrics on the test split of a model fitted on the training split."""
    parts = export.with_split(_features(spark, sf_dir).withColumnRenamed("sample_id", "id"), 0.2).withColumnRenamed("id", "sample_id")
    classes = export.with_split(_class_labels(spark, sf_dir).withColumnRenamed("sample_id", "id"), 0.2).withColumnRenamed("id", "sample_id")
    side = lambda df, name: df.where(F.col("split") == name).drop("split")
    weights = model.fit(side(parts, "train"), side(classes, "train"), iterations=STEPS, regularisation=SHRINK)
    predicted = model.predict_top_k(side(parts, "test"), weights, weights.count())
    scored = predicted.select("sample_id", F.explode("top").alias("t")).select("sample_id", "t.class_idx", "t.score")
    row = evaluate.metrics(scored, side(classes, "test"), 3)
    return row.select(*[F.round(c, 6).alias(c) for c in row.columns])


def _fit_cte(rows: str) -> str:
    """The same gradient steps over (sample, position) cells of the embeddings that meet ``rows``, unrolled."""
    steps = [
        "e AS MATERIALIZED (SELECT vec_id, label, embedding, ('0x' || substr(md5(CAST(vec_id AS varchar)), 1, 8))::bigint % 10000 < 2000 AS test FROM embeddings)",
        """x AS MATERIALIZED (SELECT vec_id AS i, d, test, CASE WHEN d < n THEN CAST(embedding[d + 1] AS double) ELSE 1 END AS x, d < n AS inner_cell
           FROM (SELECT *, len(embedding) AS n, unnest(range(len(embedding) + 1)) AS d FROM e) u)""",
        f"t AS MATERIALIZED (SELECT * FROM x WHERE {rows})",
        f"size AS MATERIALIZED (SELECT count(DISTINCT i)::double AS n, 1 / (0.25 * sum(x * x) / count(DISTINCT i) + {SHRINK}) AS step FROM t)",
        f"s AS MATERIALIZED (SELECT c.label AS c, g.d, g.inner_cell, coalesce(sum(CASE WHEN e.label = c.label THEN t.x END), 0) AS s FROM (SELECT DISTINCT label FROM e WHERE {rows}) c, (SELECT DISTINCT d, inner_cell FROM t) g JOIN t ON t.d = g.d JOIN e ON e.vec_id = t.i GROUP BY ALL)",
        "w0 AS MATERIALIZED (SELECT c, d, inner_cell, s, 0::double AS v, 0::double AS w FROM s)",
    ]
    for k in range(STEPS):
        steps.append(f"p{k} AS MATERIALIZED (SELECT t.i, w.c, 1 / (1 + exp(-sum(t.x * w.w))) AS p FROM t JOIN w{k} w ON t.d = w.d GROUP BY ALL)")
        steps.append(f"g{k} AS MATERIALIZED (SELECT p.c, t.d, sum(p.p * t.x) AS g FROM p{k} p JOIN t ON t.i = p.i GROUP BY ALL)")
        steps.append(f"n{k} AS MATERIALIZED (SELECT w.*, w.w - step * ((g.g - w.s) / n + CASE WHEN inner_cell THEN {SHRINK} * w.w ELSE 0 END) AS next FROM w{k} w JOIN g{k} g ON w.c = g.c AND w.d = g.d, size)")
        steps.append(f"w{k + 1} AS MATERIALIZED (SELECT c, d, inner_cell, s, next AS v, next + {k / (k + 3.0)!r} * (next - v) AS w FROM n{k})")
    return "WITH " + ",\n".join(steps)


def _pixel_images(spark, sf_dir):
    """Every embedding as a square grey image, in the shape of decoded image rows."""
    side = 8
    pixel = lambda x: F.floor(F.greatest(F.least((x.cast("double") + 0.5) * 255, F.lit(255.0)), F.lit(0.0)))
    hexed = F.array_join(F.transform("embedding", lambda x: F.lpad(F.hex(pixel(x)), 2, "0")), "")
    return table(spark, sf_dir, "embeddings").select(
        F.concat(F.lit("img/"), F.col("vec_id"), F.lit(".png")).alias("path"), F.lit(side).alias("height"), F.lit(side).alias("width"),
        F.lit(1).alias("nChannels"), F.unhex(hexed).alias("data"),
    )


def tensor_stats(spark, sf_dir):
    """Channel statistics of tensors made at the images' own size."""
    stats = images.tensor_stats(images.preprocess(_pixel_images(spark, sf_dir), (8, 8)))
    return stats.select("path", "channel", F.round("mean", 1).alias("mean"), F.round("min", 3).alias("min"), F.round("max", 3).alias("max"))


def embedded_volume(spark, sf_dir):
    """Count and size of tensors after enlarging every image."""
    return images.embedded_volume(images.preprocess(_pixel_images(spark, sf_dir), (24, 16)))


_PIXELS_CTE = """WITH px AS (SELECT vec_id, floor(greatest(least((CAST(x AS double) + 0.5) * 255, 255), 0)) AS p FROM (SELECT vec_id, unnest(embedding) AS x FROM embeddings) e),
ch AS (SELECT * FROM (VALUES (0, 103.939::double), (1, 116.779::double), (2, 123.68::double)) v(channel, m))
"""

QUERIES = {
    "export_safe": (export_safe, RATED_CTE + f"SELECT {_RESULT} FROM safe"),
    "sample_cap": (sample_cap, RATED_CTE + f"SELECT {_RESULT} FROM (SELECT * FROM safe ORDER BY h, id LIMIT 100) s"),
    "train_test_split": (
        train_test_split,
        """SELECT o_orderkey AS id, CASE WHEN ('0x' || substr(md5(CAST(o_orderkey AS varchar)), 1, 8))::bigint % 10000 < 2000 THEN 'test' ELSE 'train' END AS split
           FROM orders""",
    ),
    "dataset_card_stats": (
        dataset_card_stats,
        RATED_CTE
        + """SELECT (SELECT count(*) FROM rated) AS total_items, count(*) AS safe_items, (SELECT count(*) FROM rated) - count(*) AS excluded_items,
             count(*) FILTER (split = 'train') AS train_samples, count(*) FILTER (split = 'test') AS test_samples,
             round(count(*) * 100 / (SELECT count(*) FROM rated), 6) AS safe_percent,
             (SELECT count(DISTINCT t) FROM (SELECT lang AS t FROM safe UNION ALL SELECT source FROM safe) u) AS unique_tags,
             CASE WHEN count(*) >= 100000 THEN '100K<n<1M' WHEN count(*) >= 10000 THEN '10K<n<100K' ELSE '1K<n<10K' END AS size_class,
             true AS has_image_data FROM safe""",
    ),
    "base64_text": (
        base64_query,
        "SELECT doc_id, length(to_base64(encode(text))) AS b64_length, md5(to_base64(encode(text))) AS b64_md5 FROM documents",
    ),
    "tag_vocab": (tag_vocab, _TAGS_CTE + "SELECT idx, tag FROM vocab"),
    "encode_labels": (encode_labels, _TAGS_CTE + "SELECT DISTINCT it.id, v.idx AS class_idx FROM it JOIN vocab v ON it.tag = v.tag"),
    "decode_labels": (decode_labels, _TAGS_CTE + "SELECT tag, count(DISTINCT id) AS n_items FROM it GROUP BY tag"),
    "csv_wide_tags": (
        csv_wide_tags,
        f"""WITH {ITEMS_CTE}
            SELECT image, CAST(s AS integer) AS slot, trim(lower(tags[s].tag), E' \\t\\n\\r\\f\\v') AS tag
            FROM (SELECT image, tags, unnest(range(1, 6)) AS s FROM parsed) u WHERE image IS NOT NULL AND tags[s].tag IS NOT NULL""",
    ),
    "eval_prf": (
        eval_prf,
        _EVAL_CTE + 'SELECT round(p, 6) AS "precision", round(r, 6) AS recall, round(2 * p * r / (p + r + 1e-10), 6) AS f1_score FROM pr',
    ),
    "eval_hamming": (eval_hamming, _EVAL_CTE + "SELECT round(h, 6) AS hamming_accuracy FROM ham"),
    "eval_topk": (eval_topk, _EVAL_CTE + f"SELECT round(acc, 6) AS top_{K}_accuracy FROM topk"),
    "eval_map": (eval_map, _EVAL_CTE + "SELECT round(m, 6) AS mean_average_precision FROM map"),
    "eval_all": (
        eval_all,
        _EVAL_CTE + _all_metrics(K),
    ),
    "top_k_classes": (top_k_classes, _EVAL_CTE + "SELECT sample_id, class_idx, CAST(rank AS integer) AS rank, round(score, 6) AS score FROM best"),
    "sample_predictions": (
        sample_predictions,
        _EVAL_CTE
        + """, shown AS (SELECT DISTINCT sample_id FROM scores ORDER BY sample_id LIMIT 3),
        t AS (SELECT sample_id, class_idx, row_number() OVER (PARTITION BY sample_id ORDER BY class_idx) AS rn FROM scores WHERE is_true = 1)
        SELECT s.sample_id,
               (SELECT string_agg('class ' || class_idx, ', ' ORDER BY rn) FROM t WHERE t.sample_id = s.sample_id AND rn <= 5) AS true_tags,
               (SELECT string_agg('class ' || class_idx || printf(' (%.3f)', score), ', ' ORDER BY rank) FROM best b WHERE b.sample_id = s.sample_id) AS predicted_tags
        FROM shown s""",
    ),
    "predict_topk": (
        predict_topk,
        _PREDICT_CTE + f"SELECT sample_id, CAST(rank AS integer) AS rank, 'label ' || class_idx AS tag, round(confidence, 6) AS confidence FROM best WHERE rank <= {K}",
    ),
    "predictions_json": (
        predictions_json,
        _PREDICT_CTE
        + f"SELECT 'img/' || sample_id || '.png' AS image, 'label ' || class_idx AS best_tag, round(confidence, 6) AS best_confidence, {K} AS n_tags FROM best WHERE rank = 1",
    ),
    "fit_weights": (fit_weights, _fit_cte("true") + f" SELECT c AS class_idx, d AS position, round(v, 6) AS weight FROM w{STEPS}"),
    "fit_accuracy": (
        fit_accuracy,
        _fit_cte("NOT test")
        + ", "
        + _eval_cte(
            f"SELECT x.i AS sample_id, w.c AS class_idx, 1 / (1 + exp(-sum(x.x * w.v))) AS score, max((e.label = w.c)::int) AS is_true FROM x JOIN w{STEPS} w ON x.d = w.d JOIN e ON e.vec_id = x.i WHERE x.test GROUP BY ALL",
            3,
        )
        + _all_metrics(3),
    ),
    "tensor_stats": (
        tensor_stats,
        _PIXELS_CTE
        + """SELECT 'img/' || vec_id || '.png' AS path, channel, round(avg(p) - m, 1) AS mean, round(min(p) - m, 3) AS min, round(max(p) - m, 3) AS max
             FROM px, ch GROUP BY vec_id, channel, m""",
    ),
    "embedded_volume": (
        embedded_volume,
        "SELECT count(*) AS images, count(*) * 24 * 16 * 3 * 4 AS bytes, count(*) * 24 * 16 * 3 * 4 / 1048576.0::double AS megabytes FROM embeddings",
    ),
}
