"""People-shaped view over the driver's TPC-H-like tables.

The reference prepares a table of people (id, label, class, name, sex, age, relatives, ticket,
fare, cabin, port) that arrives as two files, a labelled one and a scoring one.  Here the same
shape is derived from ``orders`` (one person per order): orders with status P are the scoring
rows, F/O the labelled ones (F -> 1, O -> 0).  Nulls are injected by key arithmetic because the
driver's tables have none.  :data:`PEOPLE_SQL` is the same view in plain SQL for the oracle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwright.sources.io import union_sources
from tabwright.sources.tables import read_table

PEOPLE_COLUMNS = [
    "person_id", "is_test", "label", "family_key", "cabin_raw", "port_raw", "fare_raw", "age_raw",
    "ticket_group_key", "n_relatives", "name_raw", "sex_raw", "class_raw",
]


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Aggregated on the join key, so the aggregate's hash partitioning serves the join as well.
    return (read_table(spark, sf_dir, "lineitem", ["l_orderkey", "l_quantity"])
            .groupBy("l_orderkey")
            .agg(F.count(F.lit(1)).alias("n_lines"), F.max("l_quantity").alias("qty")))


def _orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "orders",
                      ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"])


def _shape(orders: DataFrame, spark: SparkSession, sf_dir: str, extra: list[str]) -> DataFrame:
    """orders (+ any extra columns) joined to customer and the per-order line aggregate."""
    customer = read_table(spark, sf_dir, "customer", ["c_custkey", "c_name", "c_nationkey", "c_mktsegment"])
    lines = _lines(spark, sf_dir)
    key = F.col("o_orderkey")
    return (orders.join(customer, orders.o_custkey == customer.c_custkey)
            .join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .select(
                key.alias("person_id"),
                *[F.col(c) for c in extra],
                F.col("o_custkey").alias("family_key"),
                F.col("c_mktsegment").alias("cabin_raw"),
                F.when(key % 11 == 0, F.lit(None)).otherwise(F.col("o_orderpriority")).alias("port_raw"),
                F.when(key % 97 == 0, F.lit(None)).otherwise(F.col("o_totalprice")).alias("fare_raw"),
                F.when(key % 5 == 0, F.lit(None)).otherwise(F.col("qty").cast("double")).alias("age_raw"),
                F.month("o_orderdate").cast("int").alias("ticket_group_key"),
                F.coalesce(F.col("n_lines"), F.lit(0)).alias("n_relatives"),
                F.col("c_name").alias("name_raw"),
                F.when(F.col("c_nationkey") % 2 == 0, F.lit("female")).otherwise(F.lit("male")).alias("sex_raw"),
                (F.col("c_nationkey") % 3 + 1).cast("int").alias("class_raw"),
            ))


def _label() -> F.Column:
    return F.when(F.col("o_orderstatus") == "F", 1.0).when(F.col("o_orderstatus") == "O", 0.0).cast("double")


def people(spark: SparkSession, sf_dir: str, via_union: bool = False) -> DataFrame:
    """Labelled rows (status F/O) and scoring rows (status P, no label) in one table.

    The default builds it in one pass over the joins (source flag and label are expressions).
    ``via_union=True`` stacks the two sources first with :func:`union_sources` (the scoring
    side has no label column, so it gets a null label) and joins the dimension and the line
    aggregate once, after the union — the same rows."""
    orders = _orders(spark, sf_dir)
    if not via_union:
        shaped = _shape(orders, spark, sf_dir, ["o_orderstatus"])
        return (shaped.withColumn("is_test", F.when(F.col("o_orderstatus") == "P", 1).otherwise(0))
                .withColumn("label", F.when(F.col("o_orderstatus") == "P", F.lit(None)).otherwise(_label()))
                .select(*PEOPLE_COLUMNS))
    train = orders.filter(F.col("o_orderstatus") != "P").withColumn("label", _label()).drop("o_orderstatus")
    scoring = orders.filter(F.col("o_orderstatus") == "P").drop("o_orderstatus")
    stacked = union_sources(train, scoring, "is_test")
    return _shape(stacked, spark, sf_dir, ["is_test", "label"]).select(*PEOPLE_COLUMNS)


PEOPLE_SQL = """
SELECT o.o_orderkey AS person_id,
       CASE WHEN o.o_orderstatus = 'P' THEN 1 ELSE 0 END AS is_test,
       CAST(CASE o.o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 END AS DOUBLE) AS label,
       o.o_custkey AS family_key,
       c.c_mktsegment AS cabin_raw,
       CASE WHEN o.o_orderkey % 11 = 0 THEN NULL ELSE o.o_orderpriority END AS port_raw,
       CASE WHEN o.o_orderkey % 97 = 0 THEN NULL ELSE o.o_totalprice END AS fare_raw,
       CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE CAST(l.qty AS DOUBLE) END AS age_raw,
       CAST(month(o.o_orderdate) AS INT) AS ticket_group_key,
       coalesce(l.n_lines, 0) AS n_relatives,
       c.c_name AS name_raw,
       CASE WHEN c.c_nationkey % 2 = 0 THEN 'female' ELSE 'male' END AS sex_raw,
       CAST(c.c_nationkey % 3 + 1 AS INT) AS class_raw
FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN (SELECT l_orderkey, count(*) AS n_lines, max(l_quantity) AS qty
           FROM lineitem GROUP BY l_orderkey) l ON l.l_orderkey = o.o_orderkey
"""


def with_people(sql: str) -> str:
    """Prefix an oracle query with the people view as a CTE named ``people``."""
    body = sql.strip()
    if body.upper().startswith("WITH "):
        return f"WITH people AS ({PEOPLE_SQL}),\n{body[5:]}"
    return f"WITH people AS ({PEOPLE_SQL})\n{body}"
