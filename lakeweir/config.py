"""Connection settings taken from the environment; secrets have no default."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass, field


def _required(env: Mapping[str, str], name: str) -> str:
    value = env.get(name)
    if not value:
        raise KeyError(f"environment variable {name} is not set")
    return value


@dataclass(frozen=True)
class JdbcConfig:
    """Where a database is and how to log in; the password stays out of ``repr``."""

    host: str
    port: int
    database: str
    user: str
    password: str = field(repr=False)
    driver: str = "com.mysql.cj.jdbc.Driver"
    protocol: str = "mysql"
    connect_timeout_ms: int = 30_000
    socket_timeout_ms: int = 30_000

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> JdbcConfig:
        env = os.environ if env is None else env
        return cls(
            host=_required(env, "MYSQL_HOST"),
            port=int(env.get("MYSQL_PORT", "3306")),
            database=_required(env, "MYSQL_DB"),
            user=_required(env, "MYSQL_USER"),
            password=_required(env, "MYSQL_PASSWORD"),
        )

    @property
    def url(self) -> str:
        return (
            f"jdbc:{self.protocol}://{self.host}:{self.port}/{self.database}"
            f"?connectTimeout={self.connect_timeout_ms}&socketTimeout={self.socket_timeout_ms}"
        )


@dataclass(frozen=True)
class KafkaConfig:
    """Broker address and login; the password stays out of ``repr``."""

    bootstrap_servers: str
    username: str
    password: str = field(repr=False)
    security_protocol: str = "SASL_PLAINTEXT"
    sasl_mechanism: str = "PLAIN"

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> KafkaConfig:
        env = os.environ if env is None else env
        return cls(
            bootstrap_servers=_required(env, "KAFKA_BOOTSTRAP_SERVERS"),
            username=_required(env, "KAFKA_USERNAME"),
            password=_required(env, "KAFKA_PASSWORD"),
        )

    @property
    def jaas(self) -> str:
        def quoted(text: str) -> str:
            return '"' + text.replace("\\", "\\\\").replace('"', '\\"') + '"'

        return (
            "org.apache.kafka.common.security.plain.PlainLoginModule required "
            f"username={quoted(self.username)} password={quoted(self.password)};"
        )
