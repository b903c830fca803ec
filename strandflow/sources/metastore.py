"""Parameterised queries on registered tables (a JDBC reader in production)."""

from pyspark.sql import DataFrame, SparkSession


def run_stored_query(spark: SparkSession, text: str, run_id: str) -> DataFrame:
    """Run stored SQL with the lower-cased run id bound as `:run_id`, never pasted in."""
    return spark.sql(text, args={"run_id": run_id.lower()})


def register_tables(spark: SparkSession, url: str, tables: list[str], properties: dict[str, str]) -> None:
    """Tables of a remote metastore as views, for stored queries."""
    for name in tables:
        spark.read.jdbc(url, name, properties=properties).createOrReplaceTempView(name)
