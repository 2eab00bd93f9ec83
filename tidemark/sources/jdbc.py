"""Optional JDBC connector; the driver jar and the database come from outside."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Jdbc:
    url: str
    user: str
    password: str
    driver: str = "org.postgresql.Driver"

    def options(self) -> dict[str, str]:
        return {"url": self.url, "user": self.user, "password": self.password, "driver": self.driver}

    def read_query(
        self, spark: SparkSession, query: str, partition_column: str | None = None, lower: int = 0, upper: int = 0,
        partitions: int = 1, fetch_size: int = 10_000,
    ) -> DataFrame:
        """Result of a query as a subselect, read in parallel ranges where a
        partition column is given."""
        return spark.read.format("jdbc").options(**self.read_options(
            query, partition_column, lower, upper, partitions, fetch_size)).load()

    def read_options(
        self, query: str, partition_column: str | None = None, lower: int = 0, upper: int = 0, partitions: int = 1,
        fetch_size: int = 10_000,
    ) -> dict[str, str]:
        chosen = {**self.options(), "dbtable": f"({query}) AS warehouse_query", "fetchsize": str(fetch_size)}
        if partition_column:
            chosen |= {
                "partitionColumn": partition_column, "lowerBound": str(lower), "upperBound": str(upper),
                "numPartitions": str(partitions)}
        return chosen

    def append(self, frame: DataFrame, table: str, batch_size: int = 1000) -> None:
        (frame.write.format("jdbc").options(**self.options()).option("dbtable", table)
         .option("batchsize", str(batch_size)).mode("append").save())
