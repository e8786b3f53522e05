import os
from datetime import date, datetime

from rainfold.plans import pipeline
from rainfold.plans.pipeline import Warehouse
from tests.helpers import records
from tests.test_pipeline import SEED, document
from tests.test_streaming import land


def test_a_run_leaves_no_scratch_and_its_report_is_stored(spark, tmp_path):
    seed = tmp_path / "seed.csv"
    seed.write_text(SEED)
    land(tmp_path / "landing", "one.jsonl", document())
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    warehouse = Warehouse(spark, str(tmp_path / "root"))
    report = pipeline.run(
        warehouse, str(tmp_path / "landing"), str(seed), datetime(2024, 1, 10), lookback_days=7
    )
    assert set(os.listdir(shared)) == before
    assert report.count() == 107
    assert spark.read.parquet(warehouse.path("checks", "report")).count() == 107
    fact = spark.read.parquet(warehouse.path("gold", "fct_daily"))
    assert records(fact, "dates") == [(date(2024, 1, 1),)]
