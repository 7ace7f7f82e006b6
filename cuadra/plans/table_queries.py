"""Queries on tables: the modelling table, projections, joins, aggregates, ordering, splits.

Doubles are rounded, because the order of a sum changes its last digits. No column of the source
tables holds a null, so nulls are made from values (``nullif``) or by keys without a match.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.functions import normal, scalars
from cuadra.operators import aggregate as A
from cuadra.operators import columns as P
from cuadra.operators import joins as J
from cuadra.operators import order as O
from cuadra.operators.sets import union_all
from cuadra.plans.mining import clean_for_model, mining_table
from cuadra.plans.registry import Tables, query


def rounded(df: DataFrame, cols: list[str], digits: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), digits) for c in cols})


# ---- the modelling table ------------------------------------------------------------------

FREQUENCY = {"1-URGENT": "immediate", "2-HIGH": "weekly", "5-LOW": "monthly"}
# A loan is told by its account and its number in it.
KEYS = ["loan_account", "loan_no"]
MODEL_COLUMNS = [
    "region", "balance", "frequency", "loan_amount", "loan_quantity", "loan_tax",
    "operation", "avg_amount", "avg_balance", "n_transactions",
]


def _stats(t: Tables) -> DataFrame:
    return A.account_summary(t.lineitem, "l_orderkey", "l_linestatus", "l_extendedprice", "l_quantity").withColumnRenamed(
        "l_orderkey", "summed_account"
    )


def _mining(t: Tables) -> DataFrame:
    # Keys of some regions and some accounts are nulled, so that both kinds of outer join have
    # rows without a match.
    client = t.customer.select(
        F.col("c_custkey").alias("client_no"),
        F.col("c_nationkey").alias("home_no"),
        F.col("c_acctbal").alias("balance"),
        P.gender_from_birth(F.substring("c_name", -6, 6), pad=False).alias("gender"),
    )
    district = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.when(F.col("r_name") != "ASIA", F.col("n_nationkey")).alias("place_no"),
        F.col("n_name").alias("district"),
        F.col("r_name").alias("region"),
    )
    disp = t.orders.select(
        F.col("o_custkey").alias("holder_no"),
        F.col("o_orderkey").alias("held_account"),
        F.col("o_orderpriority").alias("disposition"),
    )
    account = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("account_no"),
        P.case_when("o_orderpriority", FREQUENCY, "not stated").alias("frequency"),
    )
    loan = t.lineitem.select(
        F.col("l_orderkey").alias("loan_account"),
        F.col("l_linenumber").alias("loan_no"),
        F.col("l_extendedprice").alias("loan_amount"),
        F.col("l_quantity").alias("loan_quantity"),
        F.col("l_tax").alias("loan_tax"),
        F.col("l_returnflag").alias("status"),
    )
    return mining_table(client, district, disp, account, loan, _stats(t))


def mining_clean_frame(t: Tables) -> DataFrame:
    return clean_for_model(_mining(t), KEYS + MODEL_COLUMNS, "status", ("A", "R"), "Candidate", "No candidate")


MINING_SQL = """
WITH places AS (
  SELECT n_nationkey AS place_no, n_name AS district, r_name AS region
  FROM nation JOIN region ON r_regionkey = n_regionkey WHERE r_name <> 'ASIA'
), totals AS (
  SELECT l_orderkey AS summed_account, max(l_linestatus) AS operation, avg(l_extendedprice) AS avg_amount,
         avg(l_quantity) AS avg_balance, count(*) AS n_transactions
  FROM lineitem GROUP BY ALL
), holders AS (
  SELECT c_custkey AS client_no, c_nationkey AS home_no, c_acctbal AS balance,
         CASE WHEN substring(c_name, length(c_name) - 3, 2) > '50' THEN 'mujer' ELSE 'hombre' END AS gender,
         places.*
  FROM customer LEFT JOIN places ON c_nationkey = place_no
), accounts AS (
  SELECT holders.*, o_custkey AS holder_no, o_orderkey AS held_account, o_orderpriority AS disposition, o_orderkey AS account_no,
         CASE left(o_orderpriority, 1) WHEN '1' THEN 'immediate' WHEN '2' THEN 'weekly' WHEN '5' THEN 'monthly'
              ELSE 'not stated' END AS frequency, totals.*
  FROM orders JOIN holders ON client_no = o_custkey LEFT JOIN totals ON summed_account = o_orderkey
  WHERE o_orderstatus <> 'P'
), mining AS (
  SELECT accounts.*, l_orderkey AS loan_account, l_linenumber AS loan_no, l_extendedprice AS loan_amount,
         l_quantity AS loan_quantity, l_tax AS loan_tax, l_returnflag AS status
  FROM lineitem LEFT JOIN accounts ON account_no = l_orderkey
), clean AS (
  SELECT loan_account, loan_no, region, balance, frequency, loan_amount, loan_quantity, loan_tax, operation, avg_amount,
         avg_balance, n_transactions, CASE WHEN status = 'N' THEN 'No candidate' ELSE 'Candidate' END AS candidate
  FROM mining
  -- Nothing else can be missing: a loan without an account has no balance, and some places no region.
  WHERE balance IS NOT NULL AND region IS NOT NULL
)
"""


@query(MINING_SQL + "SELECT * REPLACE (round(avg_amount, 6) AS avg_amount, round(avg_balance, 6) AS avg_balance) FROM mining",
       name="mining_table")
def _mining_table(t):
    return rounded(_mining(t), ["avg_amount", "avg_balance"])


@query(MINING_SQL + "SELECT * REPLACE (round(avg_amount, 6) AS avg_amount, round(avg_balance, 6) AS avg_balance) FROM clean")
def mining_clean(t):
    return rounded(mining_clean_frame(t), ["avg_amount", "avg_balance"])


@query(MINING_SQL + "SELECT candidate, count(*) AS n_rows FROM clean GROUP BY candidate")
def candidate_counts(t):
    return A.count_by(mining_clean_frame(t), "candidate", out="n_rows")


@query("""
SELECT l_orderkey, max(l_linestatus) AS operation, round(avg(l_extendedprice), 6) AS avg_amount,
       round(avg(l_quantity), 6) AS avg_balance, count(*) AS n_transactions
FROM lineitem GROUP BY l_orderkey""")
def account_summary(t):
    return rounded(
        A.account_summary(t.lineitem, "l_orderkey", "l_linestatus", "l_extendedprice", "l_quantity"),
        ["avg_amount", "avg_balance"],
    )


# ---- joins --------------------------------------------------------------------------------


@query("""
SELECT c_custkey, c_nationkey, nation_key, n_name
FROM customer LEFT JOIN (SELECT CASE WHEN n_regionkey <> 2 THEN n_nationkey END AS nation_key, n_name FROM nation)
  ON c_nationkey = nation_key""")
def left_join(t):
    nation = t.nation.select(F.when(F.col("n_regionkey") != 2, F.col("n_nationkey")).alias("nation_key"), "n_name")
    return J.left_join(t.customer.select("c_custkey", "c_nationkey"), nation, "c_nationkey", "nation_key")


@query("""
SELECT o_orderkey, o_custkey, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity
FROM orders JOIN lineitem ON o_orderkey = l_orderkey""")
def inner_join(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return J.inner_join(t.orders.select("o_orderkey", "o_custkey"), lines, "o_orderkey", "l_orderkey")


@query("""
SELECT account_key, o_orderpriority, l_orderkey, l_linenumber, l_extendedprice
FROM (SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS account_key, o_orderpriority FROM orders)
RIGHT JOIN lineitem ON account_key = l_orderkey""")
def right_join(t):
    account = t.orders.select(
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("account_key"), "o_orderpriority"
    )
    return J.right_join(account, t.lineitem.select("l_orderkey", "l_linenumber", "l_extendedprice"), "account_key", "l_orderkey")


@query("""
SELECT c_custkey, customer_key, operation, round(avg_amount, 6) AS avg_amount, round(avg_balance, 6) AS avg_balance,
       n_transactions
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN c_custkey END AS customer_key FROM customer)
LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS operation, avg(o_totalprice) AS avg_amount,
                  avg(o_orderkey) AS avg_balance, count(*) AS n_transactions FROM orders GROUP BY o_custkey)
  ON customer_key = o_custkey""")
def left_join_agg(t):
    left = t.customer.select("c_custkey", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_custkey")).alias("customer_key"))
    joined = J.left_join_agg(left, "customer_key", t.orders, "o_custkey", "o_orderpriority", "o_totalprice", "o_orderkey")
    return rounded(joined, ["avg_amount", "avg_balance"])


@query("""
SELECT o_orderkey, o_totalprice AS model_a, round(o_totalprice * 1.01, 6) AS model_b,
       round(abs(o_totalprice - round(o_totalprice * 1.01, 6)), 6) AS diff
FROM orders""")
def prediction_parity(t):
    a = t.orders.select("o_orderkey", F.col("o_totalprice").alias("prediction"))
    b = t.orders.select("o_orderkey", F.round(F.col("o_totalprice") * 1.01, 6).alias("prediction"))
    return rounded(J.prediction_parity(a, b, "o_orderkey", "prediction", "model_a", "model_b"), ["diff"])


@query("""
SELECT l_orderkey, min(l_extendedprice) AS low, max(l_extendedprice) AS high FROM lineitem GROUP BY l_orderkey""")
def side_by_side(t):
    low = t.lineitem.groupBy("l_orderkey").agg(F.min("l_extendedprice").alias("prediction"))
    high = t.lineitem.groupBy("l_orderkey").agg(F.max("l_extendedprice").alias("prediction"))
    return J.side_by_side(low, high, "l_orderkey", "prediction", "low", "high")


# ---- projections, recodes, missing values --------------------------------------------------


@query("SELECT p_partkey, p_brand, p_size FROM part")
def select_cols(t):
    return P.select_cols(t.part, "p_partkey", "p_brand", "p_size")


@query("SELECT n_nationkey AS districtid, n_name AS district, c_custkey AS client FROM nation JOIN customer ON n_nationkey = c_nationkey")
def alias_columns(t):
    joined = t.nation.join(t.customer, F.col("n_nationkey") == F.col("c_nationkey"))
    return P.alias(joined, {"n_nationkey": "districtid", "n_name": "district", "c_custkey": "client"})


@query("SELECT c_custkey, c_mktsegment AS segment FROM customer")
def rename_dotted(t):
    dotted = t.customer.select("c_custkey", F.col("c_mktsegment").alias("segment."))
    return P.rename(dotted, "segment.", "segment")


@query("SELECT c_custkey AS customer_key, c_acctbal AS account_balance FROM customer")
def normalize_names(t):
    return P.normalize_names(P.alias(t.customer, {"c_custkey": "customer key", "c_acctbal": "account balance"}))


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders")
def drop_cols(t):
    return P.drop_cols(t.orders, "o_orderstatus", "o_orderdate", "o_orderpriority")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice AS market_value FROM lineitem")
def with_column(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return P.drop_cols(P.with_column(lines, "market_value", "l_extendedprice"), "l_extendedprice")


@query("SELECT s_suppkey, 1 AS is_supplier FROM supplier")
def with_constant(t):
    return P.with_constant(t.supplier.select("s_suppkey"), "is_supplier", 1)


@query("""
SELECT o_orderkey, CASE WHEN p = '1-URGENT' THEN 'immediate' WHEN p = '2-HIGH' THEN 'weekly' WHEN p = '5-LOW' THEN 'monthly'
                        ELSE 'not stated' END AS frequency
FROM (SELECT o_orderkey, nullif(o_orderpriority, '1-URGENT') AS p FROM orders)""")
def case_when(t):
    p = t.orders.select("o_orderkey", F.nullif("o_orderpriority", F.lit("1-URGENT")).alias("p"))
    return p.select("o_orderkey", P.case_when("p", FREQUENCY, "not stated").alias("frequency"))


@query("""
SELECT c_custkey, CASE WHEN substring(lpad(CAST(birth AS VARCHAR), 6, '0'), 3, 2) <= '50' THEN 'hombre' ELSE 'mujer' END AS gender
FROM (SELECT c_custkey, CASE WHEN c_mktsegment <> 'BUILDING' THEN (c_custkey * 7919) % 1000000 END AS birth FROM customer)""")
def gender_from_birth(t):
    birth = F.when(F.col("c_mktsegment") != "BUILDING", (F.col("c_custkey") * 7919) % 1_000_000)
    return t.customer.select("c_custkey", P.gender_from_birth(birth).alias("gender"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN l_returnflag IN ('A', 'R') THEN 'Candidate' ELSE 'No candidate' END AS candidate
FROM lineitem""")
def label_in_set(t):
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        P.label_in_set("l_returnflag", ("A", "R"), "Candidate", "No candidate").alias("candidate"),
    )


@query("SELECT p_partkey, CASE WHEN p_size >= 25 THEN 1 ELSE 0 END AS p_size FROM part")
def threshold_flag(t):
    return P.threshold_flag(t.part.select("p_partkey", "p_size"), "p_size", 25)


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def filter_eq(t):
    return P.filter_eq(t.orders.select("o_orderkey", "o_orderstatus", "o_totalprice"), "o_orderstatus", "F")


def _holed(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.nullif("l_discount", F.lit(0.0)).alias("discount"),
        F.nullif("l_tax", F.lit(0.0)).alias("tax"),
        F.nullif("l_returnflag", F.lit("N")).alias("flag"),
        F.col("l_quantity").alias("quantity"),
    )


HOLED_SQL = """
WITH holed AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, nullif(l_discount, 0.0) AS discount, nullif(l_tax, 0.0) AS tax,
         nullif(l_returnflag, 'N') AS flag, l_quantity AS quantity
  FROM lineitem)
"""
HOLES = ["discount", "tax", "flag", "quantity"]


@query(HOLED_SQL + """
SELECT CAST(discount IS NULL AS INT) AS discount, CAST(tax IS NULL AS INT) AS tax, CAST(flag IS NULL AS INT) AS flag, count(*) AS n_rows
FROM holed GROUP BY 1, 2, 3""")
def null_mask(t):
    mask = P.null_mask(_holed(t), ["discount", "tax", "flag"])
    return A.count_by(mask.select(*[scalars.flag(F.col(c)).alias(c) for c in mask.columns]), "discount", "tax", "flag", out="n_rows")


@query(HOLED_SQL + """
SELECT CAST(sum(CASE WHEN discount IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS discount,
       CAST(sum(CASE WHEN tax IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS tax,
       CAST(sum(CASE WHEN flag IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS flag,
       CAST(sum(CASE WHEN quantity IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS quantity
FROM holed""")
def null_counts(t):
    return P.null_counts(_holed(t), HOLES)


@query(HOLED_SQL + """
SELECT CAST(bool_or(discount IS NULL) AS INT) AS discount, CAST(bool_or(tax IS NULL) AS INT) AS tax,
       CAST(bool_or(flag IS NULL) AS INT) AS flag, CAST(bool_or(quantity IS NULL) AS INT) AS quantity
FROM holed""")
def any_null(t):
    found = P.any_null(_holed(t), HOLES)
    return found.select(*[scalars.flag(F.col(c)).alias(c) for c in found.columns])


@query(HOLED_SQL + "SELECT * FROM holed WHERE discount IS NOT NULL AND tax IS NOT NULL AND flag IS NOT NULL AND quantity IS NOT NULL")
def drop_nulls(t):
    return P.drop_nulls(_holed(t), HOLES)


@query(HOLED_SQL + """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       round(coalesce(discount, (SELECT avg(discount) FROM holed)), 6) AS discount
FROM holed""")
def fill_mean(t):
    keyed = _holed(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "discount")
    return rounded(P.fill_mean(keyed, "discount"), ["discount"])


@query(HOLED_SQL + """
, best_flag AS (SELECT flag FROM holed WHERE flag IS NOT NULL GROUP BY flag ORDER BY count(*) DESC, flag LIMIT 1),
best_tax AS (SELECT tax FROM holed WHERE tax IS NOT NULL GROUP BY tax ORDER BY count(*) DESC, tax LIMIT 1)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, coalesce(flag, (SELECT flag FROM best_flag)) AS flag,
       coalesce(tax, (SELECT tax FROM best_tax)) AS tax
FROM holed""")
def fill_mode(t):
    keyed = _holed(t).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "flag", "tax")
    return P.fill_mode(keyed, ["flag", "tax"])


@query("""
SELECT o_orderkey, TRY_CAST(left(o_orderpriority, 1) AS DOUBLE) AS head, TRY_CAST(right(o_orderpriority, 3) AS DOUBLE) AS tail
FROM orders""")
def coerce_numeric(t):
    texts = t.orders.select("o_orderkey", F.left("o_orderpriority", F.lit(1)).alias("head"), F.right("o_orderpriority", F.lit(3)).alias("tail"))
    return P.coerce_numeric(texts, ["head", "tail"])


@query("SELECT l_quantity, l_discount, count(*) AS n_rows FROM lineitem GROUP BY ALL")
def select_supported(t):
    return A.count_by(P.select_supported(t.lineitem, ["l_quantity", "l_discount"]), "l_quantity", "l_discount", out="n_rows")


@query("SELECT p_partkey, p_size + 1 AS size_plus, p_brand AS brand FROM part")
def pack_struct(t):
    packed = P.pack_struct(t.part.select("p_partkey", "p_size", "p_brand"), ["p_size", "p_brand"], "features")
    return packed.select("p_partkey", (F.col("features.p_size") + 1).alias("size_plus"), F.col("features.p_brand").alias("brand"))


@query("""
SELECT c_custkey AS party_key, c_acctbal AS balance, 1 AS is_customer FROM customer
UNION ALL SELECT s_suppkey, s_acctbal, 0 FROM supplier""")
def union_all_flagged(t):
    a = P.normalize_names(P.alias(t.customer, {"c_custkey": "party key", "c_acctbal": "balance"}))
    b = P.normalize_names(P.alias(t.supplier, {"s_acctbal": "balance", "s_suppkey": "party key"}))
    return union_all(P.with_constant(a, "is_customer", 1), P.with_constant(b, "is_customer", 0))


@query("""
SELECT c_custkey, substring(CAST(c_custkey + 1000 AS VARCHAR), 2, 2) AS digits, trim('  ' || c_mktsegment || ' ') AS segment,
       CAST(make_date(1900 + CAST(c_custkey % 90 AS INT) + 5, 1 + CAST(c_custkey % 12 AS INT), 1 + CAST(c_custkey % 28 AS INT)) AS VARCHAR) AS born,
       CASE WHEN c_nationkey = 0 THEN NULL ELSE round(c_acctbal / c_nationkey, 8) END AS per_nation,
       CAST(c_acctbal > 5000 AS INT) AS rich, round(sqrt(abs(c_acctbal)), 6) AS root
FROM customer""")
def scalar_functions(t):
    key = F.col("c_custkey")
    yymmdd = F.format_string("%02d%02d%02d", key % 90 + 5, 1 + key % 12, 1 + key % 28)
    return t.customer.select(
        "c_custkey",
        scalars.substring(key + 1000, 2, 2).alias("digits"),
        scalars.trim(F.concat(F.lit("  "), F.col("c_mktsegment"), F.lit(" "))).alias("segment"),
        # As an integer the leading zero is lost, which the parser restores.
        scalars.parse_yymmdd(yymmdd.cast("int")).cast("string").alias("born"),
        F.round(scalars.ratio(F.col("c_acctbal"), F.col("c_nationkey")), 8).alias("per_nation"),
        scalars.flag(F.col("c_acctbal") > 5000).alias("rich"),
        F.round(F.sqrt(F.abs("c_acctbal")), 6).alias("root"),
    )


# ---- aggregates ---------------------------------------------------------------------------


@query("SELECT flag, count(*) AS count FROM (SELECT nullif(l_returnflag, 'N') AS flag FROM lineitem) GROUP BY flag")
def count_by(t):
    return A.count_by(t.lineitem.select(F.nullif("l_returnflag", F.lit("N")).alias("flag")), "flag")


@query("SELECT l_returnflag, l_linestatus, count(*) AS count FROM lineitem GROUP BY ALL")
def count_by_two(t):
    return A.count_by(t.lineitem, "l_returnflag", "l_linestatus")


@query("""
SELECT c_mktsegment, round(avg(c_custkey), 4) AS avg_key, round(avg(c_nationkey), 4) AS avg_nation, round(avg(c_acctbal), 4) AS avg_balance
FROM customer GROUP BY c_mktsegment""")
def avg_by(t):
    means = A.avg_by(t.customer, "c_mktsegment").toDF("c_mktsegment", "avg_key", "avg_nation", "avg_balance")
    return rounded(means, ["avg_key", "avg_nation", "avg_balance"], 4)


@query("SELECT count(*) AS n_rows FROM lineitem")
def row_count(t):
    return A.row_count(t.lineitem)


LINE_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _describe_sql(more: str = "") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 4) AS mean, round(stddev_samp({c}), 4) AS stddev,
            round(min({c}) + 0.0, 4) AS min, round(max({c}) + 0.0, 4) AS max {more.format(c=c)} FROM lineitem"""
        for c in LINE_NUMBERS
    )


def _ends_as_numbers(df: DataFrame) -> DataFrame:
    # Adding zero turns a negative zero into a plain one.
    return rounded(df.withColumns({c: F.col(c).cast("double") + 0.0 for c in ("min", "max")}), ["mean", "stddev", "min", "max"], 4)


@query(_describe_sql() + """
UNION ALL SELECT 'l_returnflag', count(l_returnflag), NULL, NULL, NULL, NULL FROM lineitem""")
def describe(t):
    table = A.describe(t.lineitem, [*LINE_NUMBERS, "l_returnflag"])
    return _ends_as_numbers(table.withColumns({c: F.col(c).try_cast("double") for c in ("min", "max")}))


@query(_describe_sql(", round(quantile_cont({c}, 0.25), 4) AS q25, round(quantile_cont({c}, 0.5), 4) AS q50, round(quantile_cont({c}, 0.75), 4) AS q75"))
def summary_exact(t):
    return rounded(_ends_as_numbers(A.summary(t.lineitem, LINE_NUMBERS)), ["q25", "q50", "q75"], 4)


@query()
def summary_sketch(t):
    return _ends_as_numbers(A.summary(t.lineitem, LINE_NUMBERS, exact=False))


@query("""
SELECT count(*) AS count, CAST(min(d) AS VARCHAR) AS min, CAST(max(d) AS VARCHAR) AS max,
       CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(n, 0.25)) AS INT) AS VARCHAR) AS q25,
       CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(n, 0.5)) AS INT) AS VARCHAR) AS q50,
       CAST(DATE '1970-01-01' + CAST(floor(quantile_cont(n, 0.75)) AS INT) AS VARCHAR) AS q75
FROM (SELECT CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS DOUBLE) AS n FROM orders)""")
def describe_dates(t):
    table = A.describe_dates(t.orders.select(F.col("o_orderdate").cast("date").alias("d")), "d")
    return table.select("count", *[F.col(c).cast("string").alias(c) for c in ("min", "max", "q25", "q50", "q75")])


@query("SELECT p, count(*) AS count FROM (SELECT nullif(o_orderpriority, '5-LOW') AS p FROM orders) WHERE p IS NOT NULL GROUP BY p")
def value_counts(t):
    return A.value_counts(t.orders.select(F.nullif("o_orderpriority", F.lit("5-LOW")).alias("p")), "p")


@query("""
SELECT round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS sd, min(o_totalprice) AS min, max(o_totalprice) AS max
FROM orders""")
def global_stats(t):
    return rounded(A.global_stats(t.orders, "o_totalprice"), ["mean", "sd"], 4)


def _corr_sql() -> str:
    cols = ["quantity", "price", "discount", "tax"]
    rows = [f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) + 0.0 AS r FROM x" for a in cols for b in cols]
    return (
        "WITH x AS (SELECT l_quantity AS quantity, l_extendedprice AS price, nullif(l_discount, 0.0) AS discount,"
        " nullif(l_tax, 0.0) AS tax FROM lineitem) " + " UNION ALL ".join(rows)
    )


@query(_corr_sql())
def correlation_matrix(t):
    x = t.lineitem.select(
        F.col("l_quantity").alias("quantity"), F.col("l_extendedprice").alias("price"),
        F.nullif("l_discount", F.lit(0.0)).alias("discount"), F.nullif("l_tax", F.lit(0.0)).alias("tax"),
    )
    return A.correlation_matrix(x).withColumn("r", F.round("r", 6) + 0.0)


@query("""
WITH e AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem),
b AS (SELECT least(CAST(floor((l_extendedprice - lo) / ((hi - lo) / 20.0::DOUBLE)) AS INT), 19) AS bin, lo, hi FROM lineitem, e)
SELECT bin, round(lo + (hi - lo) / 20.0::DOUBLE * bin, 4) AS "left", round(lo + (hi - lo) / 20.0::DOUBLE * (bin + 1), 4) AS "right", count(*) AS count
FROM b GROUP BY bin, lo, hi""")
def histogram(t):
    return rounded(A.histogram(t.lineitem, "l_extendedprice", bins=20), ["left", "right"], 4)


def _box_sql() -> str:
    parts = [
        f"SELECT l_returnflag, '{c}' AS \"column\", CAST({c} AS DOUBLE) AS v FROM lineitem" for c in LINE_NUMBERS
    ]
    return f"""
WITH x AS ({' UNION ALL '.join(parts)}),
q AS (SELECT l_returnflag, "column", count(*) AS n, quantile_cont(v, 0.25) AS q25, quantile_cont(v, 0.5) AS q50,
             quantile_cont(v, 0.75) AS q75 FROM x GROUP BY ALL),
w AS (SELECT x.*, n, q25, q50, q75, v >= q25 - 1.5 * (q75 - q25) AND v <= q75 + 1.5 * (q75 - q25) AS within
      FROM x JOIN q USING (l_returnflag, "column"))
SELECT l_returnflag, "column", n, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
       round(least(min(v) FILTER (within), q25) + 0.0, 6) AS whisker_low,
       round(greatest(max(v) FILTER (within), q75) + 0.0, 6) AS whisker_high,
       CAST(sum(CASE WHEN within THEN 0 ELSE 1 END) AS BIGINT) AS n_outliers
FROM w GROUP BY l_returnflag, "column", n, q25, q50, q75"""


@query(_box_sql())
def box_stats(t):
    box = A.box_stats(t.lineitem, "l_returnflag", LINE_NUMBERS)
    ends = ["whisker_low", "whisker_high"]
    return rounded(box.withColumns({c: F.col(c) + 0.0 for c in ends}), ["q25", "q50", "q75", *ends])


@query("""
SELECT CAST(n_chars < 10000 AS INT) AS small, quality, count(*) AS count FROM documents JOIN labels USING (doc_id) GROUP BY ALL""")
def confusion_matrix(t):
    scored = t.documents.select("doc_id", "n_chars").join(t.labels, "doc_id")
    return A.confusion_matrix(scored.withColumn("small", scalars.flag(F.col("n_chars") < 10_000)), "quality", "small")


@query("""
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS i,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events)
SELECT event_type, i, value,
       round(CASE WHEN i = 1 THEN 1 - power(0.5, 1.0 / n) WHEN i = n THEN power(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END, 8) AS plot_position
FROM s""")
def qq_positions(t):
    return rounded(A.qq_table(t.events, "value", "event_id", ["event_type"]).drop("quantile"), ["plot_position"], 8)


def _ratio_sql(parts, x: str) -> str:
    above, below = ("".join("(" * (len(part) - 1)) + repr(part[0]) + "::DOUBLE" + "".join(f" * {x} + {c!r}::DOUBLE)" for c in part[1:]) for part in parts)
    return f"{above} / {below}"


@query(f"""
WITH s AS (SELECT event_type, value, row_number() OVER (PARTITION BY event_type ORDER BY value, event_id) AS i,
                  count(*) OVER (PARTITION BY event_type) AS n FROM events),
p AS (SELECT event_type, value, CASE WHEN i = 1 THEN 1 - power(0.5, 1.0 / n) WHEN i = n THEN power(0.5, 1.0 / n) ELSE (i - 0.3175) / (n + 0.365) END AS p FROM s),
t AS (SELECT *, p - 0.5 AS q, 0.180625 - (p - 0.5) ** 2 AS mid, sqrt(-ln(least(p, 1 - p))) - 1.6 AS tail, sqrt(-ln(least(p, 1 - p))) - 5 AS far FROM p),
z AS (SELECT event_type, value, CASE WHEN abs(q) <= 0.425 THEN q * {_ratio_sql(normal.MIDDLE, "mid")}
             ELSE sign(q) * CASE WHEN far <= 0 THEN {_ratio_sql(normal.TAIL, "tail")} ELSE {_ratio_sql(normal.FAR, "far")} END END AS z FROM t)
SELECT event_type, round(regr_slope(value, z), 6) AS slope, round(regr_intercept(value, z), 6) AS intercept, round(corr(value, z), 6) AS r
FROM z GROUP BY event_type""")
def qq_line(t):
    return rounded(A.qq_line(A.qq_table(t.events, "value", "event_id", ["event_type"]), ["event_type"]), ["slope", "intercept", "r"])


# ---- order, splits, samples ----------------------------------------------------------------


@query("SELECT o_orderkey, price FROM (SELECT o_orderkey, CASE WHEN o_totalprice > 1500 THEN o_totalprice END AS price FROM orders) ORDER BY price NULLS FIRST, o_orderkey LIMIT 5")
def bottom_k(t):
    return O.bottom_k(t.orders.select("o_orderkey", F.when(F.col("o_totalprice") > 1500, F.col("o_totalprice")).alias("price")), "price", "o_orderkey")


@query("SELECT o_orderkey, price FROM (SELECT o_orderkey, CASE WHEN o_totalprice < 400000 THEN o_totalprice END AS price FROM orders) ORDER BY price DESC NULLS LAST, o_orderkey LIMIT 5")
def top_k(t):
    return O.top_k(t.orders.select("o_orderkey", F.when(F.col("o_totalprice") < 400000, F.col("o_totalprice")).alias("price")), "price", "o_orderkey")


@query("SELECT event_id, event_type FROM events ORDER BY ts, event_id LIMIT 10")
def preview(t):
    return O.preview(t.events.select("event_id", "event_type", "ts"), ["ts", "event_id"]).drop("ts")


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def sort_by_time(t):
    return O.sort_by_time(t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").cast("string").alias("day")), "day", "o_orderkey")


@query("""
SELECT p_brand AS feature, round(avg(l_extendedprice), 4) AS importance FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand""")
def rank_features(t):
    joined = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
    means = joined.groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.avg("l_extendedprice"), 4).alias("importance"))
    return O.rank_features(means)


@query("""
SELECT o_custkey, round(avg(o_totalprice), 4) AS auc FROM orders GROUP BY o_custkey ORDER BY auc DESC, o_custkey LIMIT 1""")
def best_by_metric(t):
    trials = t.orders.groupBy("o_custkey").agg(F.round(F.avg("o_totalprice"), 4).alias("auc"))
    return O.best_by_metric(trials, "auc", "o_custkey")


@query()
def random_split(t):
    parts = O.random_split(t.orders.select("o_orderkey", "o_totalprice"), [0.7, 0.3], seed=42)
    return union_all(P.with_constant(parts[0], "part", "train"), P.with_constant(parts[1], "part", "test"))


@query("""
SELECT o_orderkey, CASE WHEN b < 6000 THEN 'train' WHEN b < 8000 THEN 'val' ELSE 'test' END AS part
FROM (SELECT o_orderkey, CAST('0x' || substring(md5(CAST(o_orderkey AS VARCHAR)), 1, 8) AS BIGINT) % 10000 AS b FROM orders)""")
def hash_split(t):
    return O.hash_split(t.orders.select("o_orderkey"), "o_orderkey", [("train", 0.6), ("val", 0.2), ("test", 0.2)])


@query("SELECT o_orderkey, o_totalprice, CAST(1 AS BIGINT) AS n_parts FROM orders")
def random_split_whole(t):
    """Each row is in exactly one part."""
    parts = O.random_split(t.orders.select("o_orderkey", "o_totalprice"), [0.5, 0.2, 0.3], seed=42)
    return A.count_by(union_all(union_all(parts[0], parts[1]), parts[2]), "o_orderkey", "o_totalprice", out="n_parts")


@query("SELECT c_custkey, c_name FROM customer UNION ALL SELECT c_custkey, c_name FROM customer")
def sample_whole(t):
    """A sample and the rows that it left out make up the table; so does a sample of everything."""
    rows = t.customer.select("c_custkey", "c_name")
    some = O.sample_fraction(rows, 0.5, seed=7)
    rest = rows.join(some.select("c_custkey"), "c_custkey", "left_anti")
    return union_all(union_all(some, rest), O.sample_fraction(rows, 1.0, seed=7))


@query()
def sample_fraction(t):
    return O.sample_fraction(t.customer, 0.5, seed=7)


@query("SELECT c_custkey, c_name FROM customer ORDER BY md5(CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 100")
def sample_n(t):
    return O.sample_n(t.customer.select("c_custkey", "c_name"), "c_custkey", 100)
