"""Options for databases and brokers, checked without connecting anywhere."""

from __future__ import annotations

import json
import os
from types import SimpleNamespace

import pytest
from pyspark.sql import types as T

from lakeweir.config import JdbcConfig, KafkaConfig
from lakeweir.schemas import AVERAGES_DDL, GROUP_KEYS, TOPIC
from lakeweir.session import scratch_path, shuffle_partitions_for
from lakeweir.sinks.jdbc import jdbc_write_options, write_jdbc
from lakeweir.sources.jdbc import Split, jdbc_read_options, read_jdbc
from lakeweir.sources.topics import (
    KafkaTopics,
    kafka_publish_options,
    kafka_range_options,
    kafka_subscribe_options,
)

ENV = {
    "MYSQL_HOST": "db", "MYSQL_PORT": "3307", "MYSQL_DB": "olympics",
    "MYSQL_USER": "reader", "MYSQL_PASSWORD": "s3cret",
    "KAFKA_BOOTSTRAP_SERVERS": "b1:9092,b2:9092",
    "KAFKA_USERNAME": "user", "KAFKA_PASSWORD": 'p"w\\d',
}
DB = JdbcConfig.from_env(ENV)
BROKERS = KafkaConfig.from_env(ENV)


class Recorder:
    """Stands for a reader or writer and notes what is asked of it."""

    def __init__(self):
        self.seen = {}

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.seen[name] = kwargs or args
            return self
        return call


class FakeFrame:
    def __init__(self):
        self.write = Recorder()


class FakeSession:
    def __init__(self):
        self.read = Recorder()
        self.readStream = Recorder()


@pytest.mark.parametrize("name", [n for n in ENV if n != "MYSQL_PORT"])
def test_every_setting_is_required(name):
    env = {k: v for k, v in ENV.items() if k != name}
    with pytest.raises(KeyError, match=name):
        (JdbcConfig if name.startswith("MYSQL") else KafkaConfig).from_env(env)


def test_port_has_a_default():
    assert JdbcConfig.from_env({k: v for k, v in ENV.items() if k != "MYSQL_PORT"}).port == 3306


def test_passwords_stay_out_of_text():
    assert "s3cret" not in repr(DB) and "p\"w" not in repr(BROKERS)


def test_jdbc_read_options():
    assert jdbc_read_options(DB, "bio") == {
        "url": "jdbc:mysql://db:3307/olympics?connectTimeout=30000&socketTimeout=30000",
        "driver": "com.mysql.cj.jdbc.Driver",
        "dbtable": "bio",
        "user": "reader",
        "password": "s3cret",
        "fetchsize": "10000",
    }
    split = jdbc_read_options(DB, "bio", Split("athlete_id", "1", "900", 12))
    assert {k: split[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")} == {
        "partitionColumn": "athlete_id", "lowerBound": "1", "upperBound": "900",
        "numPartitions": "12"}


def test_jdbc_scan_forms():
    spark = FakeSession()
    read_jdbc(spark, DB, "bio")
    assert spark.read.seen["format"] == ("jdbc",) and "load" in spark.read.seen
    read_jdbc(spark, DB, "bio", predicates=["id < 5", "id >= 5"])
    seen = spark.read.seen["jdbc"]
    assert seen["predicates"] == ["id < 5", "id >= 5"]
    assert "url" not in seen["properties"] and seen["properties"]["fetchsize"] == "10000"


def test_jdbc_append():
    frame = FakeFrame()
    write_jdbc(frame, DB, "averages", AVERAGES_DDL, connections=8)
    assert frame.write.seen["mode"] == ("append",)
    options = frame.write.seen["options"]
    assert options == jdbc_write_options(DB, "averages", AVERAGES_DDL, connections=8)
    assert options["createTableColumnTypes"].startswith("sport VARCHAR(100)")
    assert options["numPartitions"] == "8"


def test_column_types_are_valid_ddl(spark):
    schema = T.StructType.fromDDL(AVERAGES_DDL)
    assert schema.fieldNames() == [*GROUP_KEYS, "avg_height", "avg_weight", "timestamp"]


def test_kafka_login():
    options = kafka_publish_options(BROKERS, "out")
    assert options["kafka.bootstrap.servers"] == "b1:9092,b2:9092"
    assert options["kafka.security.protocol"] == "SASL_PLAINTEXT"
    assert options["kafka.sasl.mechanism"] == "PLAIN"
    assert options["kafka.sasl.jaas.config"] == (
        "org.apache.kafka.common.security.plain.PlainLoginModule required "
        'username="user" password="p\\"w\\\\d";')


def test_kafka_publish():
    options = kafka_publish_options(BROKERS, "out")
    assert options["topic"] == "out"
    assert options["kafka.batch.size"] == "16384" and options["kafka.linger.ms"] == "5"
    assert options["kafka.request.timeout.ms"] == options["kafka.max.block.ms"] == "60000"
    assert "topic" not in kafka_publish_options(BROKERS, None)


def test_kafka_subscribe():
    options = kafka_subscribe_options(
        BROKERS, "in", max_offsets_per_trigger=1000, fail_on_data_loss=False)
    assert options["subscribe"] == "in" and options["startingOffsets"] == "earliest"
    assert options["maxOffsetsPerTrigger"] == "1000" and options["failOnDataLoss"] == "false"
    assert kafka_subscribe_options(BROKERS, "in")["failOnDataLoss"] == "true"
    by_pattern = kafka_subscribe_options(BROKERS, pattern="a.*", min_partitions=64)
    assert by_pattern["subscribePattern"] == "a.*" and by_pattern["minPartitions"] == "64"
    for wrong in ({}, {"topic": "a", "pattern": "b"}):
        with pytest.raises(ValueError):
            kafka_subscribe_options(BROKERS, **wrong)


def test_kafka_ranges():
    options = kafka_range_options(BROKERS, "t", {1: 5, 0: 2}, None)
    assert json.loads(options["startingOffsets"]) == {"t": {"0": 2, "1": 5}}
    assert options["endingOffsets"] == "latest"
    assert kafka_range_options(BROKERS, "t", None, {0: 9})["startingOffsets"] == "earliest"


def test_kafka_ranges_leave_out_partitions_without_bounds():
    options = kafka_range_options(BROKERS, "t", {1: 5, 0: 2}, {1: 9, 3: 4})
    assert json.loads(options["assign"]) == {"t": [1]} and "subscribe" not in options
    assert json.loads(options["startingOffsets"]) == {"t": {"1": 5}}
    assert json.loads(options["endingOffsets"]) == {"t": {"1": 9}}
    assert kafka_range_options(BROKERS, "t", None, None)["subscribe"] == "t"
    with pytest.raises(ValueError):
        kafka_range_options(BROKERS, "t", {0: 1}, {1: 1})


def test_kafka_topics_use_these_options():
    topics, spark, frame = KafkaTopics(BROKERS), FakeSession(), FakeFrame()
    topics.read_stream(spark, "in", max_per_trigger=1000)
    assert spark.readStream.seen["format"] == ("kafka",)
    assert spark.readStream.seen["options"]["maxOffsetsPerTrigger"] == "1000"
    topics.read(spark, "in", end={0: 5})
    assert json.loads(spark.read.seen["options"]["endingOffsets"]) == {"in": {"0": 5}}
    topics.write(frame, "out")
    assert frame.write.seen["format"] == ("kafka",) and "save" in frame.write.seen


def test_topic_layout_is_that_of_kafka():
    assert TOPIC.fieldNames() == [
        "key", "value", "topic", "partition", "offset", "timestamp", "timestampType"]


def fake_session(master, **settings):
    conf = SimpleNamespace(get=lambda name, default=None: settings.get(name, default))
    return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))


def test_scratch_follows_the_session():
    session = fake_session("yarn", **{"spark.checkpoint.dir": "hdfs://shared/scratch/"})
    a, b = scratch_path(session, "x"), scratch_path(session, "x")
    assert a != b and a.startswith("hdfs://shared/scratch/x-")


def test_local_folder_only_in_local_mode():
    assert os.path.isdir(os.path.dirname(scratch_path(fake_session("local[2]"), "x")))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch_path(fake_session("yarn"), "x")


def test_shuffle_width_grows_with_the_data():
    assert shuffle_partitions_for(1 << 20, cores=8) == 16
    assert shuffle_partitions_for(1 << 40, cores=8) == 8192
