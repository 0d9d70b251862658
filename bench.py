"""Times the headline queries and prints one JSON line.

The arrivals mart is timed twice: as the library builds it, and as a plain job that
runs one count per check. Source files are written before the clock starts.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, functions as F

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = (
    "destinations_of_orders", "dedupe_on_key", "dedupe_report", "distinct_projection",
    "missing_report_sequential", "profile_columns", "duplicate_row_count", "dense_id",
    "pk_check", "fk_orphans", "fk_check", "row_balance", "quartiles", "outliers_iqr",
    "vertical_split", "enrich_ports", "climate_join", "warming_vs_origin", "state_trend",
    "age_distribution", "label_last_wins", "partitioned_roundtrip", "partition_refresh",
    "csv_roundtrip",
)


def session() -> SparkSession:
    base = tempfile.mkdtemp(prefix="starmart-bench-")
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]").appName("starmart-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def operator_by_operator(spark: SparkSession, source: str, dst: str) -> None:
    """The fact table with the library's operators called one after another, an action for each.

    What a user does who explores: nothing is stored between the steps, so each one starts at the source.
    """
    from starmart import operators as op
    from starmart.contracts import FACT_IMMIGRATION
    from starmart.plans.mart import _finish, typed_columns
    from starmart.plans.recipes import RECIPES
    from starmart.sinks import write_table
    from starmart.sources import read_csv

    recipe = RECIPES["fact_immigration"]
    rows = typed_columns(recipe, read_csv(spark, source), "lenient")
    drain(op.row_count(rows))
    drain(op.dedupe_report(rows, recipe.key))
    single = op.dedupe(rows, recipe.key, prefer_complete=recipe.critical)
    drain(op.missing_report(single, recipe.critical))
    kept = op.sparse_id(op.drop_missing(single, recipe.critical), FACT_IMMIGRATION.id_column)
    write_table(_finish(kept, recipe).select(*FACT_IMMIGRATION.columns), dst, FACT_IMMIGRATION.partition_by)


def main() -> None:
    spark = session()
    from spark_checks import QUERIES
    from spark_checks.inputs import arrivals, as_csv
    from starmart.plans import run
    from starmart.session import new_path

    drain(QUERIES["select_rename"](spark, SF_DIR))
    source = as_csv(arrivals(spark, SF_DIR), "arrivals")

    def mart(**options):
        tables = options.pop("tables")
        return lambda: run(
            spark, "", new_path(spark, "mart"), tables=tables, paths={"immigration": source},
            checks=False, **options,
        )

    fact = ["fact_immigration"]
    three = [*fact, "dim_immigration_personal", "dim_immigration_airline"]
    plain = {}
    seconds = {}
    for _ in range(2):  # the second, warm round counts, here and below
        plain["fact_operator_by_operator"] = timed(
            lambda: operator_by_operator(spark, source, new_path(spark, "plain"))
        )
        seconds["mart_fact"] = timed(mart(tables=fact))
        seconds["mart_fact_sparse_ids"] = timed(mart(tables=fact, ids="sparse"))
        seconds["mart_arrivals_three_tables"] = timed(mart(tables=three))
    for name in HEADLINES:
        for _ in range(2):
            seconds[name] = timed(lambda: drain(QUERIES[name](spark, SF_DIR)))
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "comparison": plain, "sf": os.path.basename(SF_DIR.rstrip("/")),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
