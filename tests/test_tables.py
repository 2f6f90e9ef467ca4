from datetime import date

import pytest
from pyspark.sql import functions as F

from hearthlift.functions.calendar import epoch_within, within_period
from hearthlift.sources import staging
from hearthlift.sources.tables import TableAccess, load, register_parquet, run_sql, save
from tests.conftest import SMALL, rows


def test_register_read_publish(spark):
    register_parquet(spark, SMALL, {"raw_parts": "part"})
    access = TableAccess(spark)
    access.publish(access.read("raw_parts").where("p_size > 20"))
    assert spark.table("result").count() == spark.table("raw_parts").where("p_size > 20").count() > 0


@pytest.mark.parametrize("ending", [".parquet", ".csv", ".json"])
def test_outputs_come_back(spark, tmp_path, ending):
    df = spark.createDataFrame([(1, "a,b", 0.5), (2, None, 1.5)], "id int, text string, x double")
    access = TableAccess(spark, output_folders={"t": str(tmp_path)}, save_folder=str(tmp_path), extra_outputs=True)
    access.save_output(df, f"out{ending}")
    assert rows(access.read_output("t", f"out{ending}", df.schema)) == rows(df)


def test_outputs_are_guarded(spark, tmp_path):
    df = spark.range(1)
    with pytest.raises(RuntimeError):
        TableAccess(spark, save_folder=str(tmp_path)).save_output(df, "a.parquet")
    with pytest.raises(RuntimeError):
        TableAccess(spark, extra_outputs=True).read_output("unknown", "a.parquet")
    with pytest.raises(ValueError):
        save(df, str(tmp_path / "a.xlsx"))
    with pytest.raises(ValueError):
        load(spark, str(tmp_path / "a.xlsx"))


def test_parameters_and_columns(spark):
    access = TableAccess(spark, columns={"t": {"key": "physical"}}, parameters={"START": ("2023-01-01", "string")})
    assert (access.parameter("START"), access.parameter_type("START")) == ("2023-01-01", "string")
    assert (access.column("t", "key"), access.column("t", "other")) == ("physical", "other")
    with pytest.raises(KeyError):
        access.parameter("END")


def test_sql_placeholders(spark):
    spark.range(10).createOrReplaceTempView("ten")
    df = run_sql(spark, "SELECT count(*) AS n FROM @big JOIN @ten USING (id) WHERE id >= :low", {"big": spark.range(5)}, low=2)
    assert df.first().n == 3


def test_staged_tables_lie_in_the_staging_folder(spark):
    staged = staging.stage(spark.range(5), "numbers")
    assert staged.count() == 5
    root = staging.staging_root(spark)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or root == f"{shared}/{spark.sparkContext.applicationId}"
    assert all(root in f for f in staged.inputFiles())


def test_staging_needs_a_shared_folder_on_a_cluster():
    class Conf:
        @staticmethod
        def get(name, default):
            return default

    for master in ("yarn", "local-cluster[3,2,1000]"):
        context = type("Context", (), {"master": master})
        session = type("Session", (), {"conf": Conf, "sparkContext": context})
        with pytest.raises(RuntimeError):
            staging.staging_root(session)


def test_an_empty_table_can_be_staged_by_folders(spark):
    staged = staging.stage(spark.range(0).withColumn("part", F.lit(1)), "none", ["part"])
    assert staged.count() == 0 and staged.columns == ["id", "part"]


def files_read(df) -> int:
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(k).metrics().apply("numFiles").value() for k in range(leaves.size()))


def test_tables_laid_out_by_day_are_read_by_day(spark, tmp_path, conf):
    conf("spark.sql.adaptive.enabled", "false")
    day = 86_400
    df = spark.range(6000).selectExpr(
        "CAST(id % 97 AS STRING) AS lr_id", f"IF(id % 3 = 0, 0, id % 29) * {day} + id % {day} AS transaction_timestamp_unix", "id"
    )
    access = TableAccess(spark, output_folders={"t": str(tmp_path)}, save_folder=str(tmp_path), extra_outputs=True)
    access.save_output_by_day(df, "purchases", "transaction_timestamp_unix", ["lr_id"])
    back = access.read_days("t", "purchases", df.schema)
    assert rows(back.select(df.columns)) == rows(df)
    assert len(list((tmp_path / "purchases").glob("day=*"))) == 29
    period = within_period(back, "transaction_timestamp_unix", date(1970, 1, 6), date(1970, 1, 8))
    found = back.where(period)
    want = df.where(epoch_within(F.col("transaction_timestamp_unix"), date(1970, 1, 6), date(1970, 1, 8)))
    assert rows(found.select(df.columns)) == rows(want)
    plan = found._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "GreaterThanOrEqual(transaction_timestamp_unix" in plan
    assert files_read(found) <= 6 < files_read(back)
    # The day with a third of the rows has several files, each with its own identities.
    spans = back.where("day = DATE'1970-01-01'").groupBy(F.input_file_name()).agg(F.min("lr_id").alias("low"), F.max("lr_id").alias("high"))
    spans = sorted((r.low, r.high) for r in spans.collect())
    assert len(spans) > 1 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))
    with pytest.raises(RuntimeError):
        TableAccess(spark, save_folder=str(tmp_path)).save_output_by_day(df, "x", "transaction_timestamp_unix", ["lr_id"])
