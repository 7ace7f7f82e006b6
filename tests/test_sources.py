import pytest
from pyspark.errors import PySparkException
from pyspark.sql.utils import AnalysisException

from cuadra.operators.columns import rename
from cuadra.session import broadcast_if_small, stored_bytes, written_once
from cuadra.sources import catalog as C
from cuadra.sources import files as S


@pytest.fixture()
def folder(tmp_path):
    def write(name, text):
        path = tmp_path / name
        path.write_text(text)
        return str(path)

    return write


def test_schema_is_positional_and_the_dotted_name_can_be_renamed(spark, folder):
    path = folder("t.csv", "state,area,churn.\nKS,415, yes\nOH,408,no\n")
    df = S.read_csv(spark, path, schema="estado string, area_code string, `churn.` string")
    out = rename(df, "churn.", "churn").selectExpr("estado", "area_code", "trim(churn) AS churn")
    assert [tuple(r) for r in out.collect()] == [("KS", "415", "yes"), ("OH", "408", "no")]


def test_inferred_and_text(spark, folder):
    path = folder("t.csv", "a;b\n1;x\n2;y\n")
    assert S.read_csv(spark, path, sep=";", infer=True).dtypes == [("a", "int"), ("b", "string")]
    assert S.read_csv(spark, path, sep=";").dtypes == [("a", "string"), ("b", "string")]


def test_headerless_keeps_leading_blanks(spark, folder):
    path = folder("t.csv", "39, State-gov, 77516\n")
    row = S.read_csv(spark, path, schema="age double, work string, w double", header=False).first()
    assert tuple(row) == (39.0, " State-gov", 77516.0)


def test_timeseries_csv(spark, folder):
    path = folder("t.csv", "Fecha,Trafico\n02/01/2018,5\nnever,6\n")
    df = S.read_timeseries_csv(spark, path, "Fecha", "Fecha string, Trafico double")
    assert [(str(r.ts), r.Trafico) for r in df.collect()] == [("2018-01-02", 5.0), ("None", 6.0)]
    months = folder("m.csv", "Month,n\n1949-01,112\n")
    assert str(S.read_timeseries_csv(spark, months, "Month", "Month string, n int", fmt="yyyy-MM").first().ts) == "1949-01-01"


def test_path_round_trip_replaces_old_content(spark, tmp_path):
    path = str(tmp_path / "p")
    S.write_path(spark.range(5), path)
    S.write_path(spark.range(3), path)
    assert S.read_path(spark, path).count() == S.read_parquet(spark, path).count() == 3


def test_write_table_refuses_an_existing_one(spark):
    C.drop_table(spark, "t_once")
    C.write_table(spark.range(2), "t_once")
    with pytest.raises(AnalysisException):
        C.write_table(spark.range(2), "t_once")
    C.write_table(spark.range(4), "t_once", mode="overwrite")
    assert C.read_table(spark, "t_once").count() == 4


def test_ctas_view_and_drop(spark):
    C.create_view(spark.range(6), "v_six")
    C.drop_table(spark, "t_even")
    assert C.ctas(spark, "t_even", "SELECT * FROM v_six WHERE id % 2 = 0").count() == 3
    C.drop_table(spark, "t_even")
    C.drop_table(spark, "t_even")
    assert not spark.catalog.tableExists("t_even")


def test_insert_casts_text_by_position(spark):
    C.drop_table(spark, "t_charges")
    C.create_empty_table(spark, "t_charges", "customerID string, MontlyCharges float")
    source = spark.createDataFrame([("a", "1.5"), ("b", "none")], "id string, MonthlyCharges string")
    C.insert_select(source, ["id", "MonthlyCharges"], "t_charges")
    assert sorted(map(tuple, C.read_table(spark, "t_charges").collect())) == [("a", 1.5), ("b", None)]
    with pytest.raises(PySparkException):
        source.write.insertInto("t_charges")
    with pytest.raises(ValueError):
        C.insert_select(source, ["id"], "t_charges")


def test_csv_table(spark, folder):
    path = folder("t.csv", "a;b\n1;x\n")
    C.drop_table(spark, "t_csv")
    assert tuple(C.create_csv_table(spark, "t_csv", path, sep=";", infer=True).first()) == (1, "x")
    C.drop_table(spark, "t_csv")
    typed = C.create_csv_table(spark, "t_csv", path, columns="state string, Churn string", sep=";")
    assert typed.select("churn").first()[0] == "x"


def test_schema_report_and_local(spark):
    df = C.from_local(spark, spark.range(3).toPandas())
    assert [tuple(r) for r in C.schema_report(df).collect()] == [(0, "id", "bigint")]
    assert len(C.collect_small(df)) == 3
    with pytest.raises(ValueError):
        C.collect_small(spark.range(11), limit=10)


def test_written_once_is_read_and_not_computed_again(spark):
    from pyspark.sql import functions as F

    df = written_once(spark.range(100).withColumn("r", F.rand()))
    assert df.agg(F.sum("r")).first() == df.agg(F.sum("r")).first()


def test_broadcast_goes_by_the_bytes(spark):
    few, wide = spark.range(10), spark.range(10).selectExpr("id", "repeat(sha2(cast(id as string), 256), 4000) AS t")
    assert stored_bytes(written_once(few)) < 10_000
    hinted, plain = broadcast_if_small(few, limit=10_000), broadcast_if_small(few, limit=0)
    assert "ResolvedHint" in hinted._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in plain._jdf.queryExecution().analyzed().toString()
    assert "ResolvedHint" not in broadcast_if_small(wide, limit=10_000)._jdf.queryExecution().analyzed().toString()
    rows = spark.range(100)
    assert sorted(rows.join(hinted, "id").collect()) == sorted(rows.join(plain, "id").collect())
