import json

from pyspark.sql import functions as F

from tagmill.streaming import ingest, requests, sinks, tags

LOG = "request_id long, ts timestamp, test_name string, status_code int"


def land(path, name, docs):
    path.mkdir(parents=True, exist_ok=True)
    (path / name).write_text("\n".join(json.dumps(d) for d in docs) + "\n")


def page(*items):
    return {"items": list(items), "atEnd": False, "atStart": True}


def test_ingest_resumes_and_keeps_the_latest(spark, tmp_path):
    pages, store, state = tmp_path / "pages", str(tmp_path / "store"), str(tmp_path / "state")
    land(pages, "a.json", [page({"id": 1, "up": 1, "user": "u"}, {"id": 2, "up": 1})])
    ingest.ingest(spark, str(pages), store, state).awaitTermination()
    land(pages, "b.json", [page({"id": 2, "up": 7}, {"id": 3, "up": 1})])
    ingest.ingest(spark, str(pages), store, state).awaitTermination()
    ingest.ingest(spark, str(pages), store, state).awaitTermination()
    rows = {r.id: (r.up, r.user_name) for r in ingest.read_store(spark, store).collect()}
    assert rows == {1: (1, "u"), 2: (7, None), 3: (1, None)}
    ingest.compact(spark, store, str(tmp_path / "compact"))
    assert {r.id: r.up for r in ingest.read_store(spark, str(tmp_path / "compact")).collect()} == {1: 1, 2: 7, 3: 1}


def test_retried_epoch_counts_once(spark, tmp_path):
    path = str(tmp_path / "out")
    for _ in range(2):
        spark.range(3).write.mode("overwrite").parquet(f"{path}/epoch=0")
    assert sinks.read_epochs(spark, path, "id long, epoch long").count() == 3


def test_late_row_is_dropped_and_closed_windows_are_emitted(spark, tmp_path):
    src, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    row = lambda i, ts: {"request_id": i, "ts": ts, "test_name": "a", "status_code": 429 if i % 2 else 200}

    def run():
        stream = spark.readStream.schema(LOG).json(str(src))
        rates = requests.tumbling_rates(requests.with_event_time(stream, "1 minute"), "10 seconds")
        sinks.write_epochs(rates, out, state).awaitTermination()

    land(src, "1.json", [row(1, "2024-01-01T00:00:01Z"), row(2, "2024-01-01T00:00:02Z"), row(3, "2024-01-01T00:05:00Z")])
    run()
    land(src, "2.json", [row(4, "2024-01-01T00:00:03Z"), row(5, "2024-01-01T00:05:01Z"), row(6, "2024-01-01T00:10:00Z")])
    run()
    got = sinks.read_epochs(spark, out, "test_name string, start_us long, end_us long, requests long, limited long, epoch long")
    rows = sorted((r.start_us // 10**6 % 3600, r.requests, r.limited) for r in got.collect())
    assert rows == [(0, 2, 1), (300, 2, 2)]


def test_sessions_close_with_the_watermark_of_all_requests(spark, tmp_path):
    src, out, state = tmp_path / "log", str(tmp_path / "out"), str(tmp_path / "state")
    land(src, "1.json", [{"request_id": i, "ts": f"2024-01-01T00:00:{s:02d}Z", "test_name": "a", "status_code": 429} for i, s in enumerate((1, 20, 50))])
    land(src, "2.json", [{"request_id": 9, "ts": "2024-01-01T00:09:00Z", "test_name": "a", "status_code": 200}])
    stream = spark.readStream.schema(LOG).json(str(src))
    sinks.write_epochs(requests.cooldown_sessions(requests.with_event_time(stream, "1 minute"), 60), out, state).awaitTermination()
    got = sinks.read_epochs(spark, out, "test_name string, start_us long, last_us long, errors long, epoch long").collect()
    assert [(r.errors, (r.last_us - r.start_us) // 10**6) for r in got] == [(3, 49)]


def test_new_items_and_tag_counts(spark, tmp_path):
    pages = tmp_path / "pages"
    land(pages, "a.json", [page({"id": 1}, {"id": 2}), page({"id": 2}, {"id": 3})])
    fresh = ingest.new_item_stream(ingest.page_stream(spark, str(pages)), spark.createDataFrame([(3,)], "id long")).select("id")
    sinks.write_epochs(fresh, str(tmp_path / "new"), str(tmp_path / "s1")).awaitTermination()
    assert sorted(r.id for r in sinks.read_epochs(spark, str(tmp_path / "new"), "id long, epoch long").collect()) == [1, 2]
    details = tmp_path / "details"
    land(details, "a.json", [{"item_id": 1, "tags": [{"id": 1, "confidence": 0.5, "tag": " X"}]}])
    land(details, "b.json", [{"item_id": 2, "tags": [{"id": 1, "tag": "x"}, {"id": 2, "confidence": 1.0, "tag": "y"}]}])
    counts = tags.running_tag_counts(tags.detail_stream(spark, str(details), 1))
    sinks.write_epochs(counts, str(tmp_path / "counts"), str(tmp_path / "s2"), "update").awaitTermination()
    rows = sinks.latest_by_key(sinks.read_epochs(spark, str(tmp_path / "counts"), "tag string, frequency long, conf_sum double, epoch long"), ["tag"])
    assert {r.tag: (r.frequency, r.conf_sum) for r in rows.collect()} == {"x": (2, 0.5), "y": (1, 1.0)}
    assert rows.select(F.col("tag")).count() == 2
