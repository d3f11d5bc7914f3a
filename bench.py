"""Time the headline steps; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local cores.
Inputs are prepared untimed: CSV files, the bronze table, the measurement
table. Each step runs once to warm up and three times for the record; the median
counts.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid
from statistics import median

from labmart.operators import access, audits, bronze, concepts, gold, silver
from labmart.operators.rowid import global_row_id
from labmart.plans import bronze_to_silver, csv_to_bronze, silver_to_gold
from labmart.session import build_session, new_scratch_path
from labmart.sources import scan_lab
from registry import adapter as at
from registry.queries import QUERIES

# Published for the reference run: about 169,000 rows per second from CSV to bronze.
BASELINE_ROWS_PER_SECOND = 169_000


def sink(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def steps(spark, sf_dir: str) -> dict:
    csv = at.lab_csv(spark, sf_dir)
    rows = at.stored_bronze(spark, sf_dir)
    measurement = at.stored_measurement(spark, sf_dir)
    concept = QUERIES["load_concept"](spark, sf_dir)
    database = f"bench_{uuid.uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{new_scratch_path(spark, 'bench')}'")
    loaded = csv_to_bronze(spark, csv, f"{database}.bronze", "bench")

    stored_silver = bronze_to_silver(spark, loaded, f"{database}.silver", as_of=at.AS_OF)

    def enhanced():
        return bronze.bronze_enhanced(rows, 5)

    return {
        "omop_measurement": lambda: sink(silver.omop_measurement(rows, as_of=at.AS_OF)),
        "patient_summary": lambda: sink(gold.patient_summary(measurement)),
        "measurement_trends": lambda: sink(gold.measurement_trends(measurement)),
        "laboratory_analytics": lambda: sink(gold.laboratory_analytics(measurement)),
        "concept_backfill": lambda: sink(concepts.concept_backfill(measurement, concept)),
        "bronze_enhanced": lambda: sink(enhanced()),
        "global_row_id": lambda: sink(
            global_row_id(rows, ["sampling_datetime_utc", "patient_id", "visit_id"])
        ),
        "bronze_stats": lambda: sink(audits.bronze_stats(rows, strict=True)),
        "omop_validation": lambda: sink(audits.omop_validation(measurement)),
        "time_range_count": lambda: sink(access.time_range_count(rows, dt.date(1999, 1, 1))),
        "top_lab_codes": lambda: sink(audits.top_lab_codes(rows)),
        "csv_typed_scan": lambda: sink(
            bronze.bronze_typed(scan_lab(spark, csv), "bench", at.RUN_TS, partition_columns=True)
        ),
        "csv_to_bronze": lambda: csv_to_bronze(spark, csv, f"{database}.bronze", "bench"),
        "bronze_to_silver": lambda: bronze_to_silver(
            spark, loaded, f"{database}.measurement", as_of=at.AS_OF
        ),
        "silver_to_gold": lambda: silver_to_gold(spark, stored_silver, database),
    }


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        settings={
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            # Output files in proportion to the small tables, so that all cores write.
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    todo = steps(spark, sf_dir)
    rows = at.stored_bronze(spark, sf_dir).count()
    seconds = {}
    for name, run in todo.items():
        run()
        times = []
        for _ in range(3):
            started = time.perf_counter()
            run()
            times.append(time.perf_counter() - started)
        seconds[name] = round(median(times), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline steps",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "rows": rows,
                "csv_to_bronze_rows_per_sec": round(rows / seconds["csv_to_bronze"]),
                "baseline_csv_to_bronze_rows_per_sec": BASELINE_ROWS_PER_SECOND,
                "bronze_to_silver_rows_per_sec": round(rows / seconds["bronze_to_silver"]),
            }
        )
    )


if __name__ == "__main__":
    main()
