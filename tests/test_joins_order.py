import pytest
from pyspark.sql import functions as F

from cuadra.operators import joins as J
from cuadra.operators import order as O
from cuadra.operators.sets import union_all
from cuadra.plans.mining import clean_for_model, mining_table


def frames(spark):
    client = spark.createDataFrame([(1, 10), (2, 99), (3, 10)], "client_no int, home_no int")
    district = spark.createDataFrame([(10, "north")], "place_no int, region string")
    disp = spark.createDataFrame([(1, 100, "OWNER"), (3, 100, "DISPONENT"), (2, 200, "OWNER")], "holder_no int, held_account int, disposition string")
    account = spark.createDataFrame([(100, "monthly"), (200, "weekly"), (300, "weekly")], "account_no int, frequency string")
    loan = spark.createDataFrame([(1, 100, "A"), (2, 200, "B"), (3, 300, "C"), (4, 400, "A")], "loan_id int, loan_account int, status string")
    stats = spark.createDataFrame([(100, 7), (300, 8), (400, 9)], "summed_account int, n_transactions int")
    return client, district, disp, account, loan, stats


def test_mining_table_equals_the_join_chain_in_order(spark):
    client, district, disp, account, loan, stats = frames(spark)
    chain = (
        client.join(district, client.home_no == district.place_no, "left")
        .join(disp, client.client_no == disp.holder_no)
        .join(account, disp.held_account == account.account_no)
        .join(loan, account.account_no == loan.loan_account, "right")
        .join(stats, account.account_no == stats.summed_account, "left")
    )
    got = mining_table(client, district, disp, account, loan, stats)
    assert got.columns == chain.columns
    assert sorted(map(repr, got.collect())) == sorted(map(repr, chain.collect()))


def test_mining_table_semantics(spark):
    rows = mining_table(*frames(spark)).collect()
    # Loan 1 has two dispositions and so two rows; all loans are kept.
    assert sorted(r.loan_id for r in rows) == [1, 1, 2, 3, 4]
    by_loan = {r.loan_id: r for r in rows}
    # An unmatched loan has no statistics, even if its account has transactions.
    assert by_loan[3].n_transactions is None and by_loan[4].n_transactions is None
    assert by_loan[2].region is None and by_loan[1].n_transactions == 7


def test_clean_for_model(spark):
    table = mining_table(*frames(spark))
    clean = clean_for_model(table, ["region", "n_transactions"], "status", ("A", "C"), "yes", "no")
    assert [tuple(r) for r in clean.collect()] == [("north", 7, "yes")] * 2


def test_left_join_agg_null_key_finds_nothing(spark):
    left = spark.createDataFrame([(1, 5), (2, None)], "id int, k int")
    detail = spark.createDataFrame([(5, "a", 1.0, 2.0), (None, "b", 3.0, 4.0)], "k2 int, t string, a double, b double")
    got = {r.id: r.n_transactions for r in J.left_join_agg(left, "k", detail, "k2", "t", "a", "b").collect()}
    assert got == {1: 1, 2: None}


def test_align_on_time(spark):
    a = spark.createDataFrame([("x", "2020-01-01", 1.0), ("x", "2020-01-02", 2.0)], "k string, ts string, v double")
    b = spark.createDataFrame([("x", "2020-01-02", 9.0), ("x", "2020-01-05", 8.0)], "k string, ts string, w double")
    assert sorted((r.ts, r.rw) for r in J.align_on_time(a, b, ["k"], "ts", "w", "rw").collect()) == [("2020-01-01", None), ("2020-01-02", 9.0)]


def test_parity(spark):
    a = spark.createDataFrame([(1, 0.5), (2, 0.7)], "id int, p double")
    b = spark.createDataFrame([(2, 0.6), (1, 0.5)], "id int, p double")
    got = {r.id: r.diff for r in J.prediction_parity(a, b, "id", "p", "one", "two").collect()}
    assert got[1] == 0 and got[2] == pytest.approx(0.1)


def test_nulls_in_sorts(spark):
    df = spark.createDataFrame([(1, 1), (2, 2), (3, None)], "id int, k int")
    assert [r.k for r in O.bottom_k(df, "k", "id").collect()] == [None, 1, 2]
    assert [r.k for r in O.top_k(df, "k", "id").collect()] == [2, 1, None]


def test_hash_split_is_complete_disjoint_and_stable(spark):
    df = spark.range(5000).withColumn("v", F.col("id") * 2)
    parts = [("train", 0.6), ("val", 0.2), ("test", 0.2)]
    one = {r.id: r.part for r in O.hash_split(df.repartition(3), "id", parts).collect()}
    two = {r.id: r.part for r in O.hash_split(df.repartition(11), "id", parts).collect()}
    assert one == two and len(one) == 5000
    shares = {p: sum(v == p for v in one.values()) / 5000 for p, _ in parts}
    assert shares["train"] == pytest.approx(0.6, abs=0.03) and shares["val"] == pytest.approx(0.2, abs=0.03)
    assert {r.id: r.part for r in O.hash_split(df, "id", parts, salt="x").collect()} != one


def test_random_split_parts_add_up(spark):
    parts = O.random_split(spark.range(1000), [0.99, 0.01], 42)
    assert sum(p.count() for p in parts) == 1000
    assert parts[0].intersect(parts[1]).count() == 0


def test_samples(spark):
    df = spark.range(50)
    assert O.sample_n(df, "id", 100).count() == 50
    assert O.sample_n(df, "id", 7).count() == 7
    assert O.sample_n(df, "id", 7).collect() == O.sample_n(df.repartition(5), "id", 7).collect()
    assert 0 < O.sample_fraction(spark.range(1000), 0.5, 1).count() < 1000


def test_best_by_metric_ignores_missing_metrics(spark):
    df = spark.createDataFrame([("a", 0.7), ("b", 0.9), ("c", None), ("d", 0.9)], "run string, auc double")
    assert O.best_by_metric(df, "auc", "run").first().run == "b"
    assert O.best_by_metric(df, "auc", "run", largest=False).first().run == "a"


def test_union_all_goes_by_name_and_keeps_duplicates(spark):
    a = spark.createDataFrame([(1, "x")], "n int, s string")
    b = spark.createDataFrame([("x", 1)], "s string, n int")
    assert [tuple(r) for r in union_all(a, b).collect()] == [(1, "x"), (1, "x")]


def test_hot_account_is_split(spark):
    """A third of the loans on one account: the loan join must not be one task."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for k, v in changed.items():
        spark.conf.set(k, v)
    try:
        key = F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 5000).cast("int")
        loan = spark.range(300_000).select(F.col("id").alias("loan_id"), key.alias("loan_account"), F.rand(1).alias("amount"))
        ids = spark.range(5000).select(F.col("id").cast("int").alias("i"))
        client = ids.select(F.col("i").alias("client_no"), (F.col("i") % 9).alias("home_no"))
        district = ids.filter("i < 9").select(F.col("i").alias("place_no"), F.lit("r").alias("region"))
        disp = ids.select(F.col("i").alias("holder_no"), F.col("i").alias("held_account"))
        account = ids.select(F.col("i").alias("account_no"), F.lit("m").alias("frequency"))
        stats = ids.select(F.col("i").alias("summed_account"), F.lit(1).alias("n"))
        table = mining_table(client, district, disp, account, loan, stats)
        total = table.agg(F.count(F.lit(1)), F.sum(F.hash(*table.columns).cast("double")))
        assert total.collect()[0][0] == 300_000
        assert "skew=true" in total._jdf.queryExecution().executedPlan().toString()
    finally:
        for k in changed:
            spark.conf.unset(k)


def test_null_keys_are_split_by_their_hash(spark):
    df = spark.createDataFrame([(None,)] * 5 + [("a",)], "id string")
    parts = [(str(i), 0.1) for i in range(10)]
    by = {O.hash_split(df.filter("id is null"), "id", parts, salt=str(s)).first().part for s in range(8)}
    assert len(by) > 1 and O.hash_split(df, "id", parts).filter("id is null").select("part").distinct().count() == 1
