"""Command line: ``python -m lakeweir lake|publish|enrich``.

Database and broker settings come from the environment.
"""

from __future__ import annotations

import argparse
import logging

from lakeweir.config import JdbcConfig, KafkaConfig
from lakeweir.operators.joins import BROADCAST_BYTES
from lakeweir.plans import enrichment
from lakeweir.plans.lake import GoldTable, Lake, run_lake
from lakeweir.session import build_session
from lakeweir.sources.jdbc import Split, read_jdbc
from lakeweir.sources.topics import KafkaTopics
from lakeweir.streaming.ledger import BatchLedger
from lakeweir.streaming.run import ROCKSDB, TRIGGER

INPUT_LEFT = 3  # exit code of a stream that its time limit stopped

# Public Maven coordinates of the connectors.
KAFKA_PACKAGE = "org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2"
JDBC_PACKAGE = "com.mysql:mysql-connector-j:9.1.0"


def split_of(text: str) -> Split:
    """``column:lower:upper:partitions``"""
    column, lower, upper, partitions = text.split(":")
    return Split(column, lower, upper, int(partitions))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakeweir")
    jobs = top.add_subparsers(dest="job", required=True)

    lake = jobs.add_parser("lake", help="landed CSV to bronze, silver and gold")
    lake.add_argument("landing")
    lake.add_argument("root")
    lake.add_argument("--retries", type=int, default=1)
    lake.add_argument("--nan-as-null", action="store_true", help="averages skip NaN")
    lake.add_argument("--number", choices=("float", "double"), default="float")
    lake.add_argument("--exclude", nargs="*", default=[], help="text columns not to clean")

    publish = jobs.add_parser("publish", help="database table to topic")
    publish.add_argument("table")
    publish.add_argument("--topic", default=enrichment.RESULTS)
    publish.add_argument("--split", type=split_of)
    publish.add_argument("--partitions", type=int)

    enrich = jobs.add_parser("enrich", help="topic to running averages")
    enrich.add_argument("bio_table")
    enrich.add_argument("out_table")
    enrich.add_argument("checkpoint")
    enrich.add_argument("--topic", default=enrichment.RESULTS)
    enrich.add_argument("--out-topic", default=enrichment.AVERAGES)
    enrich.add_argument("--max-per-trigger", type=int)
    enrich.add_argument("--max-bytes", type=int, help="bytes of messages per micro-batch")
    enrich.add_argument("--connections", type=int, help="most connections that write at once")
    enrich.add_argument("--split", type=split_of, help="parallel scan of the bio table")
    enrich.add_argument("--broadcast-limit", type=int, default=BROADCAST_BYTES)
    enrich.add_argument("--ledger", help="folder that notes which sink has which batch")
    enrich.add_argument("--trigger", default=TRIGGER)
    enrich.add_argument("--timeout", type=float, help="seconds; none by default")
    enrich.add_argument("--restarts", type=int, default=0)
    enrich.add_argument("--state-partitions", type=int)
    enrich.add_argument("--rocksdb", action="store_true")
    return top


def main(argv: list[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO)
    args = parser().parse_args(argv)
    if args.job == "lake":
        spark = build_session("lakeweir-lake")
        run_lake(
            spark,
            args.landing,
            Lake(args.root),
            gold=GoldTable(nan_as_null=args.nan_as_null, number=args.number),
            exclude=args.exclude,
            retries=args.retries,
        )
        return 0

    db, topics = JdbcConfig.from_env(), KafkaTopics(KafkaConfig.from_env())
    spark = build_session(f"lakeweir-{args.job}", packages=(KAFKA_PACKAGE, JDBC_PACKAGE))
    if args.job == "publish":
        enrichment.publish_results(
            spark, db, topics, args.table, args.topic, args.split, args.partitions
        )
        return 0

    sinks = {
        "topic": enrichment.topic_sink(topics, args.out_topic),
        "table": enrichment.table_sink(db, args.out_table, args.connections),
    }
    if args.ledger:
        ledger = BatchLedger(args.ledger)
        sinks = {name: ledger.once(name, sink) for name, sink in sinks.items()}
    run = enrichment.run_enrichment(
        spark,
        topics,
        read_jdbc(spark, db, args.bio_table, args.split),
        list(sinks.values()),
        args.checkpoint,
        args.topic,
        args.max_per_trigger,
        broadcast_limit=args.broadcast_limit,
        max_bytes=args.max_bytes,
        trigger=args.trigger,
        timeout=args.timeout,
        restarts=args.restarts,
        state_partitions=args.state_partitions,
        state_store=ROCKSDB if args.rocksdb else None,
    )
    if run.finished:
        return 0
    logging.warning("stream stopped at its time limit; messages may be left")
    return INPUT_LEFT


if __name__ == "__main__":
    raise SystemExit(main())
