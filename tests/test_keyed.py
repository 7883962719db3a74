"""The keyed log: pinned readers, appends during a compaction, look-ups that open few files, the seen set."""

import glob
import hashlib
import os

from pyspark.sql import functions as F
from pyspark.sql.classic.dataframe import DataFrame

from pageloom.operators import blocks, routing
from pageloom.plans import catalog, ingest
from pageloom.plans.ingest import ingest_pages
from pageloom.sources import archive
from pageloom.sources.keyed import KeyedLog
from pageloom.streaming import visits as st


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def versions(spark, rows):
    return spark.createDataFrame([(md5(u), u, d, t) for u, d, t in rows], "digest string, url string, visit_date string, text string")


def test_readers_and_appends_during_a_compaction_lose_nothing(spark, tmp_path):
    old = versions(spark, [(f"u{i}", "2024-01-01", "old") for i in range(20)])
    new = versions(spark, [(f"u{i}", "2024-01-02", "new") for i in range(10)])
    late = versions(spark, [("u3", "2024-01-03", "late"), ("u99", "2024-01-03", "late")])
    path = str(tmp_path / "store")
    for batch in (old, new):
        archive.upsert_processed(spark, batch, path)
    before = archive.read_store(spark, path, old.schema)

    def reduce(rows):
        archive.upsert_processed(spark, late, path)  # an append while the compaction has read and not yet published
        return archive.latest(rows)

    store = archive.store_of(spark, path, old.schema)
    store.compact(reduce)
    want = {f"u{i}": "new" if i < 10 else "old" for i in range(20)}
    assert {r.url: r.text for r in before.collect()} == want
    assert {r.url: r.text for r in archive.read_store(spark, path, old.schema).collect()} == want | {"u3": "late", "u99": "late"}
    assert store.read().count() == 22 and len(store.live()) == 2
    # removed folders go only when asked for, and live ones stay
    assert store.vacuum(1) == 0 and store.vacuum(0) == 4
    assert {r.url: r.text for r in archive.read_store(spark, path, old.schema).collect()} == want | {"u3": "late", "u99": "late"}


def test_an_append_that_is_not_published_is_not_seen(spark, tmp_path):
    rows = versions(spark, [("a", "2024-01-01", "x")])
    store = KeyedLog(spark, str(tmp_path / "s"), rows.schema)
    store.append(rows, "one")
    store._write(rows)  # a writer that died before the entry was renamed
    store.append(rows, "one")  # a batch that runs again
    assert store.read().count() == 1 and store.index().count() == 1


def test_a_small_batch_opens_few_files(spark, tmp_path):
    urls = [f"https://x.example.org/{i}" for i in range(3000)]
    stored = spark.createDataFrame([(u, 200, "text/html", f"<p>{u}</p>") for u in urls], "url string, status int, content_type string, html string")
    found = archive.index_responses(spark, stored, str(tmp_path / "archive"))
    wanted = spark.createDataFrame([(md5(u),) for u in urls[:5] + [f"https://y.example.org/{i}" for i in range(5)]] + [(None,)], "digest string")
    total = found.index().count()
    rows = found.lookup(wanted)
    assert sorted(r.url for r in rows.collect()) == sorted(urls[:5])
    assert total > 200 and len(rows.inputFiles()) <= total / 10
    assert {f.split("/data/")[1] for f in rows.inputFiles()} <= {r.file.split("/data/")[1] for r in found.index().collect()}
    assert found.lookup(wanted.where("false")).count() == 0


def test_an_index_loses_no_row(spark, tmp_path):
    rows = versions(spark, [(f"u{i % 400}", f"{i}", "t") for i in range(1200)])
    store = KeyedLog(spark, str(tmp_path / "s"), rows.schema, digits=1, file_rows=40)
    for part in (rows.where("visit_date < '5'"), rows.where("visit_date >= '5'")):
        store.append(part)
    for sample in (0.02, 0.3, 1.0):
        keys = rows.select("digest").distinct().sample(sample, 7)
        want = rows.join(keys, "digest", "left_semi")
        got = store.lookup(keys)
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_ingest_from_an_indexed_archive(spark, tmp_path):
    html = "<html><head><title>A title here</title></head><body><article>" + "<p>Some long words of a text that is kept, with many of them.</p>" * 9 + "</article></body></html>"
    stored = spark.createDataFrame([("https://a.example.org/1", 200, "text/html", html), ("https://a.example.org/2", 404, "text/html", html)], "url string, status int, content_type string, html string")
    log = spark.createDataFrame([("2024-01-01", "Queue", f"https://a.example.org/{i}") for i in (1, 1, 2, 3)], "date string, quality string, url string")
    none = spark.createDataFrame([], "video_id string, status int, transcript string")
    plain = ingest_pages(log, stored, none).select("url", "text", "title", "error")
    indexed = ingest_pages(log, archive.index_responses(spark, stored, str(tmp_path / "a")), none).select("url", "text", "title", "error")
    assert sorted(map(tuple, plain.collect()), key=repr) == sorted(map(tuple, indexed.collect()), key=repr)
    assert {r.url[-1]: r.error for r in plain.collect()} == {"1": None, "2": "Unsuccessful response", "3": "No response"}


def test_one_url_on_a_third_of_the_log(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"u{i}") for i in range(900)] + [(-1, None)]
    visits = spark.createDataFrame(rows, "visit_id long, url string")
    stored = spark.createDataFrame([("hot", 200, "h"), ("hot", 500, "bad"), ("u1", 204, "x"), ("u2", 404, "y"), ("zz", 200, "z")], "url string, status int, html string")
    got = routing.with_response(visits, stored, hot=50)
    assert sorted((r.visit_id, r.status, r.html) for r in got.collect()) == sorted([(i, 200, "h") for i in range(0, 900, 3)] + [(1, 204, "x")])
    assert got.columns == ["url", "visit_id", "status", "html"]


def test_the_seen_set_stays_flat_and_survives_a_new_checkpoint(spark, tmp_path):
    folder, seen = str(tmp_path / "log"), st.seen_set(spark, str(tmp_path / "seen"))
    handed, runs = [], []

    def keep(fresh, name):
        handed.extend(r.url for r in fresh.collect())
        runs.append(len(seen.live()))

    lines = [f"2024-01-01\tQueue\thttps://a.example.org/{i % 7}" for i in range(40)] + ["broken"]
    for n in range(6):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.mode("append").text(folder)
    for checkpoint in ("one", "two"):
        st.stream_seen(spark, st.stream_visits(spark, folder, files_per_batch=1), seen, keep, str(tmp_path / checkpoint), runs=3)
    # the first line of each file counts as its header
    assert sorted(handed) == [f"https://a.example.org/{i}" for i in range(7)]
    assert max(runs) <= 4 and seen.read().count() == 7


def test_filters_of_files_are_as_large_as_their_rows_need(spark, tmp_path):
    log = KeyedLog(spark, str(tmp_path / "log"), spark.createDataFrame([], "digest string, v int").schema)
    log.append(spark.range(40).selectExpr("md5(cast(id as string)) AS digest", "cast(id as int) AS v"))
    files = glob.glob(f"{tmp_path}/log/data/**/*.parquet", recursive=True)
    assert files and max(map(os.path.getsize, files)) < 100_000
    assert log.read().count() == 40


def test_a_stream_leaves_store_and_quarantine_only(spark, monkeypatch):
    """What a batch writes on its way is packed and goes with it; nothing is checkpointed."""
    made = []
    for module in (ingest, st):
        monkeypatch.setattr(module, "written", lambda rows, name: made.append(blocks.written(rows, name)) or made[-1])
    checkpointed = []
    own = DataFrame.checkpoint
    monkeypatch.setattr(DataFrame, "checkpoint", lambda self, *a, **k: checkpointed.append(self) or own(self, *a, **k))
    got = catalog.all_queries()["stream_extract"].run(spark, "/root/testdata/sf0.001")
    folders = {f.removeprefix("file://").removeprefix("file:").rsplit("/", 1)[0] for m in made for f in m.inputFiles()}
    assert got.count() > 0 and len(made) >= 2 and not checkpointed
    assert not [f for f in folders if os.path.exists(f)]
