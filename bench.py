"""Seconds per headline query on $BENCH_SF_DIR with local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from fixtures import invoice_tables as tables  # noqa: E402
from paperwarden.operators import baseline, extract, features, forest, neardup  # noqa: E402
from paperwarden.operators.scale import materialise  # noqa: E402
from paperwarden.plans import pipeline  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "4")
RUNS = int(os.environ.get("BENCH_RUNS", "1"))


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    spark = (SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
             .config("spark.sql.shuffle.partitions", str(2 * int(CPUS))).config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC")
             .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g")).getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}

    def timed(name, run):
        """Median time of RUNS runs; the last result is used by the later steps."""
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            result = run()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
        return result

    # Inputs derived from the tables, not timed.
    history = materialise(tables.history(spark, SF_DIR))
    arriving = materialise(tables.new_documents(spark, SF_DIR).drop("kind").repartition(2 * int(CPUS)))
    every = materialise(tables.all_documents(spark, SF_DIR).repartition(2 * int(CPUS)))
    texts = materialise(spark.read.parquet(f"{SF_DIR}/documents.parquet").repartition(2 * int(CPUS)))

    timed("extract_fields", lambda: consume(extract.extract_fields(every).drop("raw_text")))
    base = timed("fit_baseline", lambda: baseline.fit_baseline(history))
    past = timed("history_features", lambda: materialise(features.history_features(history, base)))
    fields = timed("extract_batch", lambda: pipeline.extract_batch(arriving))
    checked = timed("features_and_rules",
                    lambda: materialise(pipeline.check_documents(fields, base, tables.REFERENCE_DATE)))
    model = pipeline.DocumentModel(base, timed("forest_fit", lambda: forest.fit_forest(past)))
    timed("forest_score", lambda: consume(model.forest.score(checked)))
    timed("near_duplicates", lambda: consume(neardup.partner_summary(
        neardup.find_near_duplicates(texts, text_col="text"))))
    timed("full_report", lambda: consume(model.score(arriving, tables.REFERENCE_DATE)))
    rows = {"documents": every.count(), "arriving": arriving.count(), "history": history.count(),
            "texts": texts.count()}
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "rows": rows, "sf": os.path.basename(SF_DIR.rstrip("/"))}))


if __name__ == "__main__":
    main()
