"""The command line and the streaming job as a whole."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeweir import __main__ as cli
from lakeweir.functions.records import from_records
from lakeweir.operators.duplicates import latest_by_key
from lakeweir.plans import enrichment
from lakeweir.plans.topic_jobs import publish_table
from lakeweir.schemas import EVENT_RESULTS, GROUP_KEYS
from lakeweir.session import scratch_path
from lakeweir.sinks.files import snapshot, write_batch
from lakeweir.sources.files import read_parquet
from lakeweir.sources.jdbc import Split
from lakeweir.sources.topics import ParquetTopics
from lakeweir.streaming.enriched import build_enriched_stream
from lakeweir.streaming.run import start_stream
from tests.athletes import BIO_HEADER, EVENT_HEADER, batch_answer, bios, events, stream_answer
from tests.test_lake import write_csv


def answer_of(df):
    return {tuple(r[k] for k in GROUP_KEYS): (r["avg_height"], r["avg_weight"])
            for r in df.collect()}


def bio_table(spark):
    kinds = "athlete_id int, name string, sex string, height string, weight string, c string"
    df = spark.createDataFrame(bios(), kinds).toDF(*BIO_HEADER)
    return df.withColumns({m: F.nullif(m, F.lit("")) for m in ("height", "weight")})


def results_table(spark):
    rows = [tuple(None if v == "" else v for v in r) for r in events()]
    return spark.createDataFrame(rows, EVENT_RESULTS)


def test_lake_command(spark, tmp_path):
    write_csv(tmp_path / "athlete_bio.csv", BIO_HEADER, bios())
    write_csv(tmp_path / "athlete_event_results.csv", EVENT_HEADER, events())
    assert cli.main(["lake", str(tmp_path), str(tmp_path / "lake")]) == 0
    gold = read_parquet(spark, str(tmp_path / "lake" / "gold" / "avg_stats"))
    assert answer_of(gold) == batch_answer(bios(), events())


def test_whole_streaming_job(spark):
    topics, path = ParquetTopics(scratch_path(spark, "t")), scratch_path(spark, "out")
    publish_table(results_table(spark), topics, enrichment.RESULTS, partitions=2)
    run = enrichment.run_enrichment(
        spark,
        topics,
        bio_table(spark),
        [enrichment.topic_sink(topics, "averages"), lambda b, i: write_batch(b, path, i)],
        scratch_path(spark, "cp"),
        max_per_trigger=1,
        trigger=None,
        state_partitions=2,
    )
    assert run.finished
    stored = spark.read.parquet(path)
    sent = from_records(topics.read(spark, "averages"), stored.schema)
    for changes in (stored, sent):
        assert answer_of(latest_by_key(changes, GROUP_KEYS)) == stream_answer(bios(), events())


def test_state_width_is_that_of_the_first_start(spark):
    topics = ParquetTopics(scratch_path(spark, "t"))
    publish_table(results_table(spark), topics, "results")
    stream = build_enriched_stream(topics.read_stream(spark, "results"), bio_table(spark))
    query = start_stream(stream, lambda b, i: b.write.format("noop").mode("overwrite").save(),
                         scratch_path(spark, "cp"), trigger=None, state_partitions=3)
    assert query.awaitTermination(60)
    assert query.lastProgress.stateOperators[0].numShufflePartitions == 3


def test_snapshot_reads_its_source_once(spark, tmp_path):
    source = str(tmp_path / "source")
    spark.range(5).write.parquet(source)
    kept = snapshot(spark.read.parquet(source), str(tmp_path / "copy"))
    spark.range(9).write.mode("overwrite").parquet(source)
    assert kept.count() == 5


def test_streaming_commands_need_settings(monkeypatch):
    for name in ("MYSQL_HOST", "KAFKA_USERNAME"):
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(KeyError):
        cli.main(["publish", "results"])


def test_publish_and_enrich_commands(spark, monkeypatch):
    """Everything but the connectors: tables come from memory, topics are folders."""
    for name, value in {
        "MYSQL_HOST": "h", "MYSQL_DB": "d", "MYSQL_USER": "u", "MYSQL_PASSWORD": "p",
        "KAFKA_BOOTSTRAP_SERVERS": "b:1", "KAFKA_USERNAME": "u", "KAFKA_PASSWORD": "p",
    }.items():
        monkeypatch.setenv(name, value)
    topics, path = ParquetTopics(scratch_path(spark, "t")), scratch_path(spark, "out")
    tables = {"results": results_table, "bio": bio_table}

    def read(session, db, table, split=None):
        return tables[table](session)

    def append(df, db, table, column_types, connections=None):
        assert table == "averages" and "batch_id" in df.columns
        df.write.mode("append").parquet(path)

    monkeypatch.setattr(cli, "build_session", lambda *args, **kwargs: spark)
    monkeypatch.setattr(cli, "KafkaTopics", lambda conn: topics)
    monkeypatch.setattr(cli, "read_jdbc", read)
    monkeypatch.setattr(enrichment, "read_jdbc", read)
    monkeypatch.setattr(enrichment, "write_jdbc", append)

    assert cli.main(["publish", "results", "--partitions", "2"]) == 0
    assert topics.read(spark, enrichment.RESULTS).count() == len(events())
    arguments = ["--trigger", "1 second", "--timeout", "12", "--state-partitions", "2"]
    assert cli.main(["enrich", "bio", "averages", scratch_path(spark, "cp"), *arguments]) == cli.INPUT_LEFT
    changes = spark.read.parquet(path)
    assert answer_of(latest_by_key(changes, GROUP_KEYS)) == stream_answer(bios(), events())


def test_commands_parse():
    args = cli.parser().parse_args(["publish", "t", "--split", "id:1:9:4"])
    assert args.split == Split("id", "1", "9", 4) and args.partitions is None
    args = cli.parser().parse_args(["enrich", "bio", "out", "/cp"])
    assert (args.max_per_trigger, args.trigger, args.timeout) == (None, "5 seconds", None)
