"""A third of the rows on one key, and plans beyond a broadcast."""

from __future__ import annotations

import time
from collections import Counter

from pyspark.sql import functions as F

from lakeweir.llm.components import connected_components, dealt_by_root
from lakeweir.llm.decontamination import find_benchmark, shuffled_hits
from lakeweir.llm.storage import Workspace
from lakeweir.llm.warc import id_of, read_archive, write_archive
from tests.llm import brute

WORDS = [f"w{i}" for i in range(400)]


def rows_per_task(df):
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def found_of(documents, bench, **options):
    return {
        r.id: (r.n_words, r.n_hit, sorted(r["items"], key=str), [tuple(s) for s in r.spans])
        for r in find_benchmark(documents, bench, **options).collect()
    }


def test_benchmark_beyond_a_broadcast(spark):
    """A third of the documents hold one passage; most hold nothing."""
    items = [(i, " ".join(WORDS[i * 12 : i * 12 + 14])) for i in range(30)] + [(None, "short item"), (31, None)]
    texts = [" ".join(WORDS[:14]) if i % 3 == 0 else f"plain text number {i}" for i in range(300)]
    texts += [" ".join(WORDS), "a short item b", "", None]
    documents = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    small = found_of(documents, bench)
    assert found_of(documents, bench, broadcast_bytes=0) == small and len(small) == len(texts)
    by_row = dict(enumerate(t for _, t in items))
    for i, text in enumerate(texts):
        n, hit, keys = brute.benchmark_hits(text, by_row)
        spans = {w for a, b in small[i][3] for w in range(a, b)}
        assert small[i][:2] == (n, len(hit)) and spans == hit
        assert small[i][2] == sorted((items[k][0] for k in keys), key=str)


def test_hot_windows_are_dealt_over_tasks(spark):
    rows = spark.range(0, 30_000, 1, 4).selectExpr(
        "id", "id AS row", "10L AS n_words", "if(id % 2 = 0, id, null) AS start", "10L AS size",
        "if(id % 3 = 0, 7L, id) AS h1", "if(id % 3 = 0, 7L, id) AS h2",
    )
    rows = Workspace(spark, "test").store(rows, "rows")
    known = spark.range(30_000).selectExpr("id AS item", "10L AS size", "id AS h1", "id AS h2", "true AS match")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = shuffled_hits(rows, known)
        joined = found.filter("start is not null")
        assert joined.count() == 15_000 and found.count() == 30_000
        # A third of the windows has one hash, and the documents' own rows are not shuffled.
        assert rows_per_task(joined)[0] <= 15_000 * 2 // 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_many_spans_in_linear_time(spark):
    bench = spark.createDataFrame([(1, "hit"), (2, "two words")], "item_id bigint, text string")
    took = []
    for n in (5_000, 40_000):
        text = "hit and more two words end " * n
        frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
        began = time.monotonic()
        r = find_benchmark(frame, bench).collect()[0]
        took.append(time.monotonic() - began)
        assert r.n_hit == 3 * n and len(r.spans) == 2 * n
        assert [tuple(s) for s in r.spans[:3]] == [(0, 1), (3, 5), (6, 7)]
    assert took[1] < 8 * took[0]


def test_archive_of_one_hot_payload(spark):
    big = "z" * 1500
    rows = [(None if i == 5 else i, f"http://{i}", big if i % 3 == 0 else "" if i % 3 == 1 else f"{i}") for i in range(600)]
    rows += [(None, "http://x", "y" * 1200), (None, "http://y", "y" * 1200)]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    for limit in (32 << 20, 0):
        archive = write_archive(pages, broadcast_bytes=limit)
        assert archive.payloads.count() == 1 + 1 + 200 + 1
        found = read_archive(archive).select("id", "record_type", id_of("refers_to", "bigint").alias("to"), "payload")
        found = found.collect()
        assert Counter((r.id, bytes(r.payload).decode()) for r in found) == Counter((i, t) for i, _, t in rows)
        for r in found:
            text = bytes(r.payload).decode()
            if text == big:
                expected = ("response", None) if r.id == 597 else ("revisit", 597)
                assert (r.record_type, r.to) == expected
            elif len(text) < 1000:
                assert r.record_type == "response"
        # Of two pages without id the one with the larger url is the response; the other has no id to refer to.
        lost = sorted((r.record_type, r.to) for r in found if len(r.payload) == 1200)
        assert lost == [("response", None), ("revisit", None)]


def test_links_of_a_giant_component(spark):
    """All links lead to one root, which is the most a component can be skewed."""
    links = spark.range(1, 8_001).selectExpr("id AS a", "0L AS b").union(
        spark.range(10_000, 10_300).selectExpr("id AS a", "id + 1 AS b")
    )
    edges = Workspace(spark, "test").store(links.selectExpr("a AS u", "b AS v"), "edges")
    tasks = rows_per_task(dealt_by_root(edges, 10))
    assert sum(tasks) == 8_300 and tasks[0] <= 3_000
    found = connected_components(links, Workspace(spark, "test"), 900)
    groups = {r["component"]: r["count"] for r in found.groupBy("component").count().collect()}
    assert groups == {0: 8_001, 10_000: 301} and found.count() == found.select("node").distinct().count()
