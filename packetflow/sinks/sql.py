"""Q2-Q7: the node-info job's SQL surface.

Q2 temp view, Q3 user DDL for the sink table, Q4 `INSERT INTO … SELECT *`,
Q5 console changelog, Q6 printed schema, Q7 JDBC catalog. The DDL is the
user's: `CREATE TABLE … USING jdbc OPTIONS (…)` for a database, or any other
Spark data source (e.g. `USING parquet LOCATION '…'`).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

from packetflow.fixed import NODE_INFO_INSERT as INSERT, NODE_INFO_SINK as SINK, NODE_INFO_VIEW as VIEW

JDBC_CATALOG_CLASS = "org.apache.spark.sql.execution.datasources.v2.jdbc.JDBCTableCatalog"


def create_sink(spark: SparkSession, ddl: str | None) -> bool:
    """Q3: run the user's sink DDL once; False when there is none."""
    if not ddl:
        log.info("no sink table DDL given; node info is not inserted anywhere")
        return False
    spark.sql(ddl)
    return True


def keeps_batches(spark: SparkSession, table: str = SINK) -> bool:
    """Whether the user's table is partitioned by `run_id` and `batch_id`, in this order, and no more."""
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition] == ["run_id", "batch_id"]


def insert_via_view(df: DataFrame, view: str = VIEW, insert: str = INSERT) -> None:
    """Q2 + Q4 on the frame's own session (inside foreachBatch, the batch's)."""
    df.createOrReplaceTempView(view)
    df.sparkSession.sql(insert)


def overwrite_via_view(df: DataFrame, batch_id: int, run_id: str, view: str = VIEW,
                       table: str = SINK) -> None:
    """Q2 + Q4 into the batch's own partition: inserting it again replaces what is there."""
    df.createOrReplaceTempView(view)
    run = run_id.replace("\\", "\\\\").replace("'", "\\'")
    df.sparkSession.sql(f"INSERT OVERWRITE {table} PARTITION (run_id = '{run}', batch_id = {int(batch_id)}) "
                        f"SELECT * FROM {view}")


def console_changelog(stream: DataFrame, checkpoint: str,
                      query_name: str = "node_info_changelog", trigger=None):
    """Q5: print the (append-only) stream; an opt-in debug sink."""
    from packetflow.streaming.runner import trigger_options

    return (stream.writeStream.format("console").outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger_options(trigger)).queryName(query_name).start())


def print_schema(df: DataFrame) -> None:
    """Q6."""
    df.printSchema()


def jdbc_catalog_conf(name: str, url: str, user: str | None = None,
                      password: str | None = None, driver: str | None = None) -> dict[str, str]:
    """Q7: session settings that register a JDBC catalog named `name`."""
    conf = {f"spark.sql.catalog.{name}": JDBC_CATALOG_CLASS,
            f"spark.sql.catalog.{name}.url": url}
    for key, value in (("user", user), ("password", password), ("driver", driver)):
        if value is not None:
            conf[f"spark.sql.catalog.{name}.{key}"] = value
    return conf


def register_jdbc_catalog(spark: SparkSession, name: str, url: str, user: str | None = None,
                          password: str | None = None, driver: str | None = None,
                          create_sql: str | None = None) -> list[str]:
    """Q7: register, use and list a JDBC catalog; optionally run a CREATE TABLE.

    Returns the catalog's namespaces (the reference logs its databases).
    """
    for key, value in jdbc_catalog_conf(name, url, user, password, driver).items():
        spark.conf.set(key, value)
    spark.catalog.setCurrentCatalog(name)
    namespaces = [r[0] for r in spark.sql(f"SHOW NAMESPACES IN {name}").collect()]
    log.debug("catalog %s namespaces: %s", name, namespaces)
    if create_sql:
        spark.sql(create_sql)
    return namespaces
