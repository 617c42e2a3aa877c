"""External tables over the gold folders."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from shoplake import schemas


def list_catalogs(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW CATALOGS")


def list_schemas(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW SCHEMAS")


def register_table(
    spark: SparkSession, name: str, columns: str, path: str, partition_column: str = "event_date"
) -> None:
    """Creates the external table if needed and adds the partitions found in its folder."""
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"PARTITIONED BY ({partition_column}) LOCATION '{path}'"
    )
    spark.sql(f"MSCK REPAIR TABLE {name} ADD PARTITIONS")


def register_gold(spark: SparkSession, gold_path: str, schema: str = "default") -> list[str]:
    """Registers the three gold tables below ``gold_path`` and returns their names."""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")
    names = []
    for table, columns in schemas.GOLD_TABLES.items():
        name = f"{schema}.{table}"
        register_table(spark, name, columns, f"{gold_path}/{table}")
        names.append(name)
    return names


def partition_rows(spark: SparkSession, name: str) -> DataFrame:
    """Rows per partition of a registered table."""
    table = F.lit(name.rsplit(".", 1)[-1]).alias("table_name")
    return spark.table(name).groupBy(table, "event_date").agg(F.count(F.lit(1)).alias("row_count"))
