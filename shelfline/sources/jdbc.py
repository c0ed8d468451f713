"""JDBC options for keeping the prediction tables in a relational database."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

# Wire settings of the SQL Server JDBC driver and the insert batch.
PORT = 1433
DRIVER = "com.microsoft.sqlserver.jdbc.SQLServerDriver"
BATCH_ROWS = 1000


@dataclass(frozen=True)
class JdbcStore:
    server: str
    database: str
    user: str
    password: str

    @classmethod
    def from_env(
        cls, env: Mapping[str, str] = os.environ, prefix: str = "FORECAST_DB"
    ) -> JdbcStore:
        """Read ``<prefix>_SERVER``, ``_DATABASE``, ``_USER`` and ``_PASSWORD``."""
        return cls(*(env[f"{prefix}_{k}"] for k in ("SERVER", "DATABASE", "USER", "PASSWORD")))

    @property
    def url(self) -> str:
        settings = {
            "databaseName": self.database,
            "encrypt": "true",
            "trustServerCertificate": "false",
        }
        tail = "".join(f"{k}={v};" for k, v in settings.items())
        return f"jdbc:sqlserver://{self.server}:{PORT};{tail}"

    def options(self, table: str) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "user": self.user,
            "password": self.password,
            "driver": DRIVER,
        }

    def read(self, spark: SparkSession, table: str, **options: str) -> DataFrame:
        """Scan a table; pass ``partitionColumn``/bounds/``numPartitions`` to split it."""
        return spark.read.format("jdbc").options(**{**self.options(table), **options}).load()

    def append(self, df: DataFrame, table: str, writers: int = 8) -> None:
        """Append in batches over at most ``writers`` connections."""
        (
            df.write.format("jdbc")
            .options(**self.options(table))
            .option("batchsize", BATCH_ROWS)
            .option("numPartitions", writers)
            .mode("append")
            .save()
        )
