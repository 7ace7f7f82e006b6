"""Queries that write whole tables in each supported form, read them back and return the copy.

They write under the shared folder, so they run on a cluster as they do here.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.aggregate import count_by
from cuadra.operators.columns import rename
from cuadra.plans.registry import Tables, query
from cuadra.session import scratch_path
from cuadra.sources import catalog as C
from cuadra.sources import files as S

CUSTOMER_SQL = "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"
CUSTOMER_TYPES = "custkey bigint, name string, nationkey int, acctbal double, mktsegment string"


def _written(t: Tables, df: DataFrame, **options) -> str:
    path = scratch_path(t.spark, "csv")
    S.write_csv(df, path, **options)
    return path


def _named(df: DataFrame) -> DataFrame:
    return df.toDF("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@query("SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, strftime(o_orderdate + INTERVAL 1 DAY, '%Y-%m-%d') AS next_day, o_orderpriority FROM orders")
def csv_inferred(t):
    copy = S.read_csv(t.spark, _written(t, t.orders), infer=True)
    # Only a date or a time can be moved by a day.
    next_day = F.date_format(F.col("o_orderdate") + F.expr("INTERVAL 1 DAY"), "yyyy-MM-dd").alias("next_day")
    return copy.select(F.col("o_orderkey").cast("bigint"), F.col("o_custkey").cast("bigint"), "o_orderstatus", "o_totalprice", next_day, "o_orderpriority")


@query(CUSTOMER_SQL)
def csv_schema(t):
    return _named(S.read_csv(t.spark, _written(t, t.customer), schema=CUSTOMER_TYPES))


@query("SELECT c_custkey, ' ' || c_name AS c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def csv_headerless(t):
    # A leading blank stays in text, while the number behind one is still a number.
    blank = t.customer.withColumns({"c_name": F.concat(F.lit(" "), "c_name"), "c_acctbal": F.concat(F.lit(" "), "c_acctbal")})
    path = scratch_path(t.spark, "csv")
    blank.write.option("header", False).option("ignoreLeadingWhiteSpace", False).csv(path)
    return _named(S.read_csv(t.spark, path, schema=CUSTOMER_TYPES, header=False))


@query("SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part")
def csv_semicolon(t):
    copy = S.read_csv(t.spark, _written(t, t.part, sep=";"), sep=";", infer=True)
    return copy.withColumn("p_partkey", F.col("p_partkey").cast("bigint"))


@query("SELECT CAST(s_suppkey AS VARCHAR) AS s_suppkey, s_name, CAST(s_nationkey AS VARCHAR) AS s_nationkey, CAST(s_acctbal AS VARCHAR) AS s_acctbal FROM supplier")
def csv_strings(t):
    return S.read_csv(t.spark, _written(t, t.supplier))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS ts, o_totalprice FROM orders")
def csv_timeseries(t):
    text = t.orders.select("o_orderkey", F.date_format("o_orderdate", "dd/MM/yyyy").alias("day"), "o_totalprice")
    copy = S.read_timeseries_csv(t.spark, _written(t, text), "day", "o_orderkey bigint, day string, o_totalprice double")
    return copy.withColumn("ts", F.col("ts").cast("string"))


@query(CUSTOMER_SQL)
def csv_table_typed(t):
    C.drop_table(t.spark, "cuadra_customer_csv")
    return _named(C.create_csv_table(t.spark, "cuadra_customer_csv", _written(t, t.customer), columns=CUSTOMER_TYPES))


@query("SELECT n_nationkey, n_name, n_regionkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey JOIN customer ON c_nationkey = n_nationkey")
def csv_table_inferred(t):
    C.drop_table(t.spark, "cuadra_nation_csv")
    nation = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).join(t.customer, F.col("c_nationkey") == F.col("n_nationkey"))
    path = _written(t, nation.select("n_nationkey", "n_name", "n_regionkey", "r_name"), sep=";")
    return C.create_csv_table(t.spark, "cuadra_nation_csv", path, sep=";", infer=True)


@query("SELECT c_custkey, c_mktsegment AS segment FROM customer")
def csv_dotted_name(t):
    path = _written(t, t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment.")))
    return rename(S.read_csv(t.spark, path, schema="c_custkey bigint, `segment.` string"), "segment.", "segment")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM lineitem")
def parquet_copy(t):
    path = scratch_path(t.spark, "lines")
    S.write_path(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"), path)
    return S.read_parquet(t.spark, path)


@query("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders")
def path_partitioned(t):
    path = scratch_path(t.spark, "orders")
    S.write_path(t.orders.select("o_orderkey", "o_totalprice", "o_orderpriority"), path, partition_by=["o_orderpriority"])
    return S.read_path(t.spark, path)


@query(CUSTOMER_SQL)
def table_copy(t):
    C.drop_table(t.spark, "cuadra_customer")
    C.write_table(t.customer, "cuadra_customer", path=scratch_path(t.spark, "table"))
    return C.read_table(t.spark, "cuadra_customer")


@query("SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey")
def table_from_query(t):
    C.create_view(t.orders, "cuadra_orders_view")
    C.drop_table(t.spark, "cuadra_order_totals")
    return C.ctas(
        t.spark,
        "cuadra_order_totals",
        "SELECT o_custkey, count(*) AS n_orders, round(sum(o_totalprice), 2) AS total FROM cuadra_orders_view GROUP BY o_custkey",
        path=scratch_path(t.spark, "totals"),
    )


@query("SELECT CAST(c_custkey AS VARCHAR) AS customer_id, CAST(CAST(c_acctbal AS FLOAT) > 2000 AS INT) AS rich FROM customer")
def insert_text_as_float(t):
    C.drop_table(t.spark, "cuadra_charges")
    C.create_empty_table(t.spark, "cuadra_charges", "customer_id string, charges float", path=scratch_path(t.spark, "charges"))
    text = t.customer.select(F.col("c_custkey").cast("string").alias("id"), F.col("c_acctbal").cast("string").alias("amount"))
    C.insert_select(text, ["id", "amount"], "cuadra_charges")
    return C.read_table(t.spark, "cuadra_charges").select("customer_id", (F.col("charges") > 2000).cast("int").alias("rich"))


@query("SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type")
def view_counts(t):
    C.create_view(t.events, "cuadra_events_view")
    return count_by(C.read_table(t.spark, "cuadra_events_view"), "event_type", out="n_rows")


@query("SELECT c_mktsegment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment")
def local_round_trip(t):
    """An aggregate goes to the driver, as for a chart, and back."""
    counts = count_by(t.customer, "c_mktsegment", out="n_rows")
    return C.from_local(t.spark, C.collect_small(counts), counts.schema)


@query("""
SELECT column_name AS "column", count(*) AS n_rows, CAST(max(n) AS BIGINT) AS filled
FROM (SELECT unnest(['c_custkey', 'c_name', 'c_nationkey', 'c_acctbal', 'c_mktsegment']) AS column_name) c,
     (SELECT count(*) AS n FROM customer) GROUP BY 1""")
def schema_report(t):
    """The schema as rows, beside the number of filled cells of each column."""
    cells = t.customer.agg(*[F.count(c).alias(c) for c in t.customer.columns]).unpivot([], t.customer.columns, "column", "filled")
    report = C.schema_report(t.customer).join(cells, "column")
    return report.groupBy("column").agg(F.count(F.lit(1)).alias("n_rows"), F.max("filled").alias("filled"))
