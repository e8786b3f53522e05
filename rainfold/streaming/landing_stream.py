"""Loading landing files as they arrive.

The batch run reads every landing file each time. Here Structured Streaming keeps track of the
files already loaded, so a run costs what arrived since the last one. The rows take the same
path as in the batch run.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame

from rainfold.functions.dates import DateSet
from rainfold.operators.series import split_unparsable
from rainfold.operators.tables import load
from rainfold.plans.pipeline import KINDS, Warehouse, add_pending, pending_dates, readings
from rainfold.schemas import LANDING, OPEN_LANDING
from rainfold.session import materialize, prepare, remove
from rainfold.sources.landing import explain_malformed, landing_stream


def load_new_landing(
    warehouse: Warehouse, landing: str, max_files_per_batch: int | None = None,
    open_variables: bool = False,
) -> DateSet | None:
    """Upsert the documents of all files not loaded before, then stop.

    Returns the days whose models wait for a rebuild, or None when there are none. They are stored
    with the warehouse before a batch counts as done, and ``build_models`` clears them, so days
    of a run that died before its rebuild come back with the next one. A batch that is repeated after
    a failure gives the same tables: its upserts write the same rows again, and its quarantine folder
    is overwritten. A broken line stops the load with its file and number. With ``open_variables`` the
    tables grow by variables they lack.
    """
    spark = prepare(warehouse.spark)

    def load_batch(documents: DataFrame, batch_id: int) -> None:
        held: list[str] = []
        records = materialize(documents, "landing", held)
        for kind in KINDS:
            usable, unparsable = split_unparsable(readings(records, kind, open_variables))
            quarantine = f"{warehouse.path('quarantine', kind.block)}/batch={batch_id}"
            unparsable.drop("p_date").write.mode("overwrite").parquet(quarantine)
            report = load(usable, warehouse.bronze(kind), kind, "upsert", grow=open_variables)
            if report.dates:
                add_pending(warehouse, report.dates)
        remove(spark, *held)

    query = (
        landing_stream(
            spark, landing, max_files_per_batch, OPEN_LANDING if open_variables else LANDING
        )
        .writeStream.foreachBatch(load_batch)
        .option("checkpointLocation", warehouse.path("checkpoints", "landing"))
        .trigger(availableNow=True)
        .start()
    )
    try:
        query.awaitTermination()
    except StreamingQueryException as error:
        raise explain_malformed(spark, landing, error) from error
    return pending_dates(warehouse)
