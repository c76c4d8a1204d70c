import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo

from ledgerweave.sources import files, remote, sinks
from ledgerweave.sources.paged import PagedSource, PushingReader, with_retry
from ledgerweave.streaming.append import append_unique_stream, harvest_step, windowed_counts


def test_csv_is_all_text_and_total(spark, tmp_path):
    (tmp_path / "a.csv").write_text('﻿id,name\n1,"two\nlines ""q"""\n2,\n', encoding="utf-8")
    got = files.csv_table(spark, str(tmp_path / "a.csv"), ["id", "name", "absent"])
    assert sorted(tuple(r) for r in got.collect()) == [("1", 'two\nlines "q"', ""), ("2", "", "")]
    assert files.csv_table(spark, str(tmp_path / "none.csv"), ["id"]).count() == 0


def test_sinks_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "b"'), ("2", None)], "id string, t string")
    sinks.write_csv(df, str(tmp_path / "o"), ["t", "id"])
    assert sorted(tuple(r) for r in files.csv_table(spark, str(tmp_path / "o"), ["id", "t"]).collect()) == [("1", 'a "b"'), ("2", "")]
    f = df.withColumn("c", F.array(F.lit(1.0), F.lit(2.0))).select(sinks.feature(F.lit("Point"), F.col("c"), ["id"]).alias("feature"))
    doc = json.loads(sinks.feature_collection(f).first()[0])
    assert doc["type"] == "FeatureCollection" and len(doc["features"]) == 2


def test_paged_source_stops_at_a_short_page(spark, tmp_path):
    for skip, n in ((0, 3), (3, 3), (6, 1)):
        (tmp_path / f"{skip}.json").write_text(json.dumps({"rows": [{"id": skip + i, "t": "x"} for i in range(n)]}))
    spark.dataSource.register(PagedSource)
    got = spark.read.format("paged").schema("id string, t string").options(url=f"file:{tmp_path}", page_size="3", max_rows="100", pages_per_task="50").load()
    assert sorted(int(r.id) for r in got.collect()) == list(range(7))
    every = spark.read.format("paged").schema("id string").options(url=f"file:{tmp_path}", page_size="3").load()
    assert every.count() == 7
    (tmp_path / "0.json").write_text(json.dumps({"rows": [{"id": i} for i in range(3)], "total": 7}))
    parts = spark.read.format("paged").schema("id string").options(url=f"file:{tmp_path}", page_size="3", pages_per_task="1").load()
    assert parts.rdd.getNumPartitions() == 3 and parts.count() == 7
    capped = spark.read.format("paged").schema("id string").options(url=f"file:{tmp_path}", page_size="3", max_rows="4").load()
    assert capped.count() == 4


def test_retry_gives_up_after_its_tries():
    calls = []

    def fail():
        calls.append(1)
        raise OSError

    try:
        with_retry(fail, tries=3, pause=0)
    except OSError:
        pass
    assert len(calls) == 3


def test_append_stream_goes_on_where_it_stopped(spark, tmp_path):
    src, out, cp = (str(tmp_path / x) for x in ("src", "out", "cp"))
    spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int").coalesce(1).write.parquet(src)
    read = lambda: spark.readStream.schema("k string, v int").parquet(src)
    append_unique_stream(read(), out, cp, ["k"], [F.asc("v")]).awaitTermination()
    spark.createDataFrame([("b", 3), ("c", 4), ("c", 5)], "k string, v int").coalesce(1).write.mode("append").parquet(src)
    append_unique_stream(read(), out, cp, ["k"], [F.asc("v")]).awaitTermination()
    assert sorted((r.k, r.v) for r in spark.read.parquet(out).collect()) == [("a", 1), ("b", 2), ("c", 4)]


def test_isolated_sources_report_failures(spark):
    def bad():
        raise ValueError("no")

    opened, status = files.isolated({"good": lambda: spark.range(1), "bad": bad}, spark)
    assert set(opened) == {"good"} and {(r.source, r.status) for r in status.collect()} == {("good", "ok"), ("bad", "failed")}


def test_a_broken_page_is_an_error(spark, tmp_path):
    (tmp_path / "0.json").write_text(json.dumps({"rows": [{"id": 1}, {"id": 2}]}))
    (tmp_path / "2.json").write_text("{broken")
    spark.dataSource.register(PagedSource)
    load = lambda folder: spark.read.format("paged").schema("id string").options(url=f"file:{folder}", page_size="2", pause="0").load().count()
    with pytest.raises(Exception, match="JSON|Expecting"):
        load(tmp_path)
    with pytest.raises(Exception, match="absent"):
        load(tmp_path / "absent")


def test_filters_go_to_the_remote_side():
    reader = PushingReader(None, {"url": "https://x.example", "filter": "y gt 1"})
    left = list(reader.pushFilters([EqualTo(("name",), "O'Hare"), EqualTo(("n",), 3)]))
    assert reader.where == "y gt 1 and name eq 'O''Hare'" and left == [EqualTo(("n",), 3)]


PDF = b"%PDF-" + b"x" * 600


def fetcher():
    pdf = PDF

    def fetch(url):
        pages = {
            "https://h/i/index.html": b'<a href="district-annual-report-2014.html">y</a><a href="/other.html">n</a>',
            "https://h/i/district-annual-report-2014.html": b'<a href="/p/T_001_2013.pdf">a</a><a href="b.pdf">b</a><a href="b.pdf">b</a>',
            "https://h/1": b'[{"a": "x", "n": 1}, {"a": "y", "n": 2}]',
            "https://h/a.pdf": pdf,
            "https://h/b.pdf": b"<html>",
        }
        if url not in pages:
            raise OSError(f"no {url}")
        return pages[url]

    return fetch


def test_remote_sources(spark):
    _fetch = fetcher()
    start = spark.createDataFrame([("https://h/i/index.html",), (None,)], "url string")
    got = remote.crawl(start, _fetch, ("district", "annual", "report"), pause=0)
    assert sorted(tuple(r) for r in got.collect()) == [("https://h/i/b.pdf", "https://h/i/district-annual-report-2014.html", 2014), ("https://h/p/T_001_2013.pdf", "https://h/i/district-annual-report-2014.html", 2013)]
    parents = spark.createDataFrame([(1, "one"), (2, "two"), (None, "none")], "id int, name string")
    rows, calls = remote.fan_out(parents, "id", ["name"], lambda k: f"https://h/{k}", _fetch, T.StructType([T.StructField("a", T.StringType()), T.StructField("n", T.IntegerType())]), tries=1)
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "one", "x", 1), (1, "one", "y", 2)] and sorted((r.id, r.status) for r in calls.collect()) == [(1, "ok"), (2, "failed")]
    links = spark.createDataFrame([(f"https://h/{x}.pdf",) for x in "abcd"], "u string")
    stored = spark.createDataFrame([("https://h/d.pdf", bytearray(PDF)), ("https://h/c.pdf", bytearray(b"no"))], "url string, content binary")
    got = remote.downloads(links, "u", stored, _fetch, tries=1)
    assert sorted((r.url[-5], r.status, r.content is not None) for r in got.collect()) == [("a", "downloaded", True), ("b", "invalid", False), ("c", "failed", False), ("d", "exists", False)]
    assert remote.downloads(links, "u", stored.limit(0), _fetch, most=1, tries=1).count() == 1
    bodies = spark.createDataFrame([("a", "ok", bytearray(b' {"error": 1}')), ("b", "ok", bytearray(b"x,y"))], "url string, status string, content binary")
    assert sorted((r.url, r.status) for r in remote.csv_bodies(bodies).collect()) == [("a", "failed"), ("b", "ok")]
    catalog = spark.createDataFrame([("City TIF-Projects",), ("Parks",), (None,)], "name string")
    assert [r.name for r in remote.catalog_hits(catalog, "name", "tif").collect()] == ["City TIF-Projects"]


def test_counts_unions_and_reading_of_images(spark, tmp_path):
    def bad():
        raise OSError

    assert sorted(tuple(r) for r in remote.source_counts(spark, {"a": lambda: spark.range(3), "b": bad}).collect()) == [("a", "ok", 3), ("b", "failed", None)]
    spark.range(2).write.parquet(str(tmp_path / "t"))
    got = remote.existing_union({"t": lambda: spark.read.parquet(str(tmp_path / "t")), "u": lambda: spark.read.parquet(str(tmp_path / "u"))}, ["id"])
    assert sorted(tuple(r) for r in got.collect()) == [(0, "t"), (1, "t")]
    with pytest.raises(FileNotFoundError):
        remote.existing_union({"u": lambda: spark.read.parquet(str(tmp_path / "u"))}, ["id"])
    pages = spark.createDataFrame([(1, "x" * 30, None), (2, " ", bytearray(b"seen")), (3, None, None)], "page int, text string, image binary")
    assert sorted((r.page, r.text, r.method) for r in remote.with_ocr(pages, "text", "image", lambda b: b.decode()).collect()) == [(1, "x" * 30, "text"), (2, "seen", "ocr"), (3, None, "ocr")]
    (tmp_path / "w.txt").write_text("a\nb")
    assert [tuple(r) for r in remote.raw_lines(spark, str(tmp_path / "w.txt")).collect()] == [(0, "a"), (1, "b")]


def test_pages_files_seeds_and_checkpoints(spark, tmp_path):
    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "0002.txt").write_text("two")
    (tmp_path / "d" / "x.pdf").write_bytes(PDF)
    pages = files.page_text(spark, str(tmp_path / "d")).filter("page is not null")
    assert [(r.page, r.text) for r in pages.collect()] == [(2, "two")]
    assert [r.length for r in files.listed_files(spark, str(tmp_path / "d"), "*.pdf").collect()] == [len(PDF)]
    cache = spark.createDataFrame([(1, "kept"), (2, " ")], "p int, t string")
    fresh = spark.createDataFrame([(1, "new"), (2, "new"), (3, None)], "p int, t string")
    assert sorted((r.p, r.t) for r in files.cached_pages(cache, fresh, ["p"], "t").collect()) == [(1, "kept"), (2, "new"), (3, None)]
    assert [tuple(r) for r in files.seeded(spark, str(tmp_path / "no.csv"), ["a", "b"], [{"a": "1"}]).collect()] == [("1", "")]
    logs = [spark.createDataFrame(x, "term_index int, next_skip int") for x in ([(0, 300), (1, 100)], [(1, 200)])]
    assert tuple(files.checkpoint(*logs).first()) == (1, 200)


def test_harvest_steps_and_windows(spark, tmp_path):
    fetched = spark.createDataFrame([("a",), ("b",)], "id string")
    fresh, row = harvest_step(fetched, spark.createDataFrame([("a",)], "id string"), "id", 0, 100, 100)
    assert [r.id for r in fresh.collect()] == ["b"] and row == {"term_index": 0, "next_skip": 200, "rows_fetched": 2, "new_rows": 1, "stop": False}
    assert harvest_step(fetched, fetched, "id", 0, 0, 100)[1]["stop"]
    spark.sql("select timestamp'2020-01-01 00:00:10' as ts, 'k' as k union all select timestamp'2020-01-01 00:00:50', 'k' union all select timestamp'2020-01-01 00:01:10', 'k'").write.parquet(str(tmp_path / "e"))
    stream = spark.readStream.schema("ts timestamp, k string").parquet(str(tmp_path / "e"))
    windowed_counts(stream, "ts", "1 minute", "1 minute", ["k"]).writeStream.format("memory").queryName("w").outputMode("complete").trigger(availableNow=True).start().awaitTermination()
    assert sorted(r.n for r in spark.sql("select n from w").collect()) == [1, 2]
