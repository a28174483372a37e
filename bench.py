"""Time the headline queries: prints one JSON line.

The ledger inputs (raw extracts, lookups, first history) and the two loads are
made once, timed and counted; the queries behind them share them openly.
"""

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from quillbook.plans import workload as w
from quillbook.plans.queries import QUERIES, _first_half
from quillbook.session import configure

HEADLINE = """extract_lines include_exclude classify_headers classify_lines line_attributes line_numbering
error_view error_records wildcard_lookup cdc_actions scd2_working scd2_history kc2_measures kc2_compare balance_lines
duplicates header_line_join hierarchy_levels batch_ids touched_documents""".split()


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = configure(
        SparkSession.builder.master(f"local[{cores}]")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="quillbook-bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times: dict[str, float] = {}

    def timed(name: str, action) -> object:
        start = time.time()
        result = action()
        times[name] = round(time.time() - start, 3)
        return result

    def run(df) -> None:
        df.write.format("noop").mode("overwrite").save()

    with w.inputs():
        inputs = timed("input_preparation", lambda: (w.extracts(spark, folder), w.lookups(spark, folder)))
        lines = sum(e.count() for e in inputs[0])
        timed("load_headers", lambda: run(w.loaded_headers(spark, folder).final))
        timed("load_lines", lambda: run(w.loaded_lines(spark, folder).final))
        timed("first_history", lambda: run(_first_half(spark, folder)))
        for name in HEADLINE:
            timed(name, lambda name=name: run(QUERIES[name](spark, folder)))
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": folder.rsplit("sf", 1)[-1],
        "raw_lines": lines,
        "classified_lines_per_sec": round(lines / times["classify_lines"]),
        "lines_loaded_per_sec": round(lines / times["load_lines"]),
    }))


if __name__ == "__main__":
    main()
