"""Benchmark of the headline jobs; prints ONE JSON line.

    BENCH_SF_DIR  input tables (default /root/testdata/sf0.1)
    BENCH_CPUS    local[N] (default 8)
    BENCH_RUNS    timed runs per job after one warm-up (default 3); median reported

  rollup            daily rollup + monthly sequences (noop sink)
  padded_array      rollup + padded sequences, array form
  padded_window     rollup + padded sequences, window form
  json_quarantine   parse + prepare + quarantine of JSON lines (lines written once, untimed)
  train_job         rollup + prepare + stage + fit + scale + split + gzip export
  batch_ids         repeatable shuffle + global batch numbers over the prepared table
  score_mllib       predict-window scoring with a saved MLlib model
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))

    from daybook.operators import layout, training
    from daybook.operators.rollup import raw_samples
    from daybook.operators.sequences import explode_days, good_rows, padded_long_window, prepare_samples
    from daybook.plans import faults
    from daybook.plans import predict as predict_plan
    from daybook.plans.train import STAGES, examples_of_lines, run_train, stage_examples
    from daybook.session import local_session
    from daybook.sources import examples
    from daybook.sources.ndjson import read_lines
    from daybook.sources.sales import lineitem_sales

    spark = local_session(cpus, shuffle_partitions=max(8, cpus * 2), app="daybook-bench")
    scratch = tempfile.mkdtemp(prefix="daybook-bench-")
    sales = lambda: lineitem_sales(spark, sf_dir)

    def noop(df):
        df.write.format("noop").mode("overwrite").save()

    lines_path = os.path.join(scratch, "lines")
    faults.json_lines(raw_samples(sales())).write.mode("overwrite").text(lines_path)
    counter = iter(range(10**6))

    def json_job():
        path, _ = stage_examples(spark, examples_of_lines(read_lines(spark, lines_path)), STAGES)
        staged = spark.read.parquet(path)
        noop(staged.where("stage IS NULL"))
        noop(staged.where("stage IS NOT NULL").select("stage", "error_class", "error_message", "raw"))

    def train_job():
        run_train(spark, sales(), os.path.join(scratch, f"ds{next(counter)}"), "2000-01-01")

    # a model for the scoring job (untimed)
    base = os.path.join(scratch, "model-run")
    dataset, model_dir = predict_plan.model_paths(base)
    run_train(spark, sales(), dataset, "2000-01-01")
    predict_plan.run_fit(spark, dataset, model_dir, num_features=1 << 17)  # narrow: the fit itself is not timed
    fitted, model = examples.load_minmax(spark, dataset), training.load(model_dir)

    def score_job():
        with predict_plan.run_predict(spark, sales(), fitted, model, "2000-07-01", "2000-07-31") as done:
            noop(done.predictions)

    def batch_job():
        prep = good_rows(prepare_samples(raw_samples(sales())))
        noop(layout.assign_batches(prep.select("item_id", "year", "month"), 32))

    jobs = {
        "rollup": lambda: noop(raw_samples(sales())),
        "padded_array": lambda: noop(explode_days(good_rows(prepare_samples(raw_samples(sales()))))),
        "padded_window": lambda: noop(padded_long_window(raw_samples(sales()))),
        "json_quarantine": json_job,
        "train_job": train_job,
        "batch_ids": batch_job,
        "score_mllib": score_job,
    }
    result = {}
    spread = {}
    for name, job in jobs.items():
        job()  # warm-up
        times = []
        for _ in range(runs):
            t0 = time.perf_counter()
            job()
            times.append(time.perf_counter() - t0)
        result[name] = round(statistics.median(times), 3)
        spread[name] = [round(min(times), 3), round(max(times), 3)]
    n_lines = spark.read.parquet(os.path.join(sf_dir, "lineitem.parquet")).count()
    out = {
        "metric": "headline_jobs_median_sum",
        "value": round(sum(result.values()), 3),
        "unit": "sec",
        "queries": result,
        "range": spread,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "lineitem_rows": n_lines,
        "cpus": cpus,
        "runs": runs,
    }
    print(json.dumps(out))


if __name__ == "__main__":
    main()
