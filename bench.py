"""Timings of the daily run and of some single queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores. The
Parquet, every Silver and Gold model written from stored tables, all table tests.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from cauce.plans.ingest import Ingestion  # noqa: E402
from cauce.plans.layers import STAGES, Warehouse  # noqa: E402
from cauce.queries import CONTEXT, QUERIES, Tables  # noqa: E402
from cauce.session import build_session, shared_folder  # noqa: E402
from cauce.sources.driver_tables import SOURCE_SYSTEM  # noqa: E402
from cauce.sources.lake import Lake  # noqa: E402

SINGLE_QUERIES = (
    "stg_movimientos", "fact_rentabilidad_cliente", "err_calidad_datos", "dq_report_silver", "kpi_cartera_diaria",
    "volume_anomaly", "inject_duplicados",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}

    def timed(name: str, action: Callable[[], object]) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    tables = Tables(spark, folder)
    ingestion = Ingestion(Lake(spark, shared_folder(spark, "bench")), SOURCE_SYSTEM)
    warehouse = Warehouse(ingestion.lake, CONTEXT)
    timed("run.bronze", lambda: ingestion.run(lambda table, _last: tables.source(table.name)))
    for stage, groups in STAGES.items():
        for model in (name for group in groups for name in group):
            timed(f"run.{model}", lambda model=model: warehouse.build(model))
        timed(f"run.tests_{stage}", lambda stage=stage: warehouse.test_layer(stage))
    timed("run.summary", lambda: warehouse.summary().collect())
    for name in SINGLE_QUERIES:
        timed(name, lambda name=name: QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save())
    print(json.dumps({
        "metric": "daily run and single queries, total seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": Path(folder).name.removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
