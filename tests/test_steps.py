import pytest

from hearthlift import schemas as S
from hearthlift.plans.retail_sources import RETAIL_CAMPAIGN, retail_sources
from hearthlift.plans.steps import STEPS, run_step
from hearthlift.sources.staging import stage
from hearthlift.sources.tables import TableAccess
from tests.conftest import SMALL


def test_jobs_hand_over_named_tables(spark):
    sources = retail_sources(spark, SMALL)
    # A table with physical column names of its own.
    sources["demographics"] = sources["demographics"].withColumnRenamed("hh_income", "income_code")
    sources["sample_insights"] = sources["demographics"]
    for name, df in sources.items():
        df.createOrReplaceTempView(name)
    renamed = {"hh_income": "income_code"}
    access = TableAccess(spark, columns={"demographics": renamed, "sample_insights": renamed})
    widths = {"raw_conversion": 16, "raw_exposure": 10, "AllFeatures": 100, "StratifiedFeatures": 105, "PSMMatchedFeatures": 106}
    for name, width in widths.items():
        result = run_step(name, access, RETAIL_CAMPAIGN)
        assert len(result.columns) == width
        stage(access.read("result"), name).createOrReplaceTempView(name)
    assert spark.table("AllFeatures").where("num_hh_income_missing_in_addresslink = 0").count() > 0
    lift = run_step("lift_psm", access, RETAIL_CAMPAIGN)
    assert lift.schema.fieldNames() == S.LIFT_SUMMARY.fieldNames()
    assert spark.table("result").count() == 1


def test_every_job_is_there():
    assert len(STEPS) == 11
    with pytest.raises(ValueError):
        run_step("other", None, RETAIL_CAMPAIGN)
