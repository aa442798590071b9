"""Published data sets that are whole or absent, interleaved reading, the table function, learned vectors, stream counters."""

import datetime as dt
import json
import os

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import spec
from daybook.operators import training
from daybook.operators.mapping import map_and_quarantine
from daybook.operators.rollup import raw_samples
from daybook.operators.scaling import footer_columns, footer_stats, stats_frame
from daybook.operators.sequences import good_rows, prepare_samples
from daybook.operators.split import mark_split
from daybook.operators.table_function import register_table_function
from daybook.plans import predict as predict_plan
from daybook.plans.train import run_train
from daybook.sources import examples, interleaved, published
from daybook.sources.sales import lineitem_sales
from daybook.streaming.prepare_stream import start_prepare_stream, stream_counts

from conftest import SF_SMALL

WHEN = dt.datetime(2020, 8, 23, 22, 51)
SPLITS = [spec.TRAIN_PREFIX, spec.TEST_PREFIX]


@pytest.fixture(scope="module")
def routed(spark):
    return mark_split(good_rows(prepare_samples(raw_samples(lineitem_sales(spark, SF_SMALL)))), "1997-01-01").cache()


def test_published_rows_come_back(spark, routed, tmp_path):
    path = published.publish(routed, str(tmp_path), WHEN, SPLITS)
    assert published.latest(spark, str(tmp_path)) == path and path.endswith("2020-08-23T22-51-00")
    for s in SPLITS:
        want = examples.to_export(routed.where(F.col("split") == s))
        got = published.read_published(spark, path, s, verify=True)
        assert got.count() == want.count() and got.exceptAll(want).isEmpty()
    with pytest.raises(FileExistsError):
        published.publish(routed, str(tmp_path), WHEN, SPLITS)
    with pytest.raises(published.Incomplete, match="no split valid"):
        published.read_published(spark, path, "valid")


def test_a_half_written_or_changed_folder_is_not_read(spark, routed, tmp_path):
    base = str(tmp_path)
    whole = published.publish(routed, base, WHEN, SPLITS)
    half = f"{base}/{published.stamp(WHEN + dt.timedelta(days=1))}"
    examples.to_export(routed, ["split"]).write.partitionBy("split").parquet(half)
    assert published.latest(spark, base) == whole
    with pytest.raises(published.Incomplete, match="no manifest"):
        published.read_published(spark, half, "train")
    # a manifest folder that was begun but not finished
    os.makedirs(f"{half}/_manifest")
    with pytest.raises(published.Incomplete, match="no manifest"):
        published.read_published(spark, half, "train")
    more = published.publish(routed, base, WHEN + dt.timedelta(days=2), SPLITS)
    routed.limit(1).drop("split").write.mode("append").parquet(f"{more}/split=train")
    with pytest.raises(published.Incomplete, match="other files"):
        published.read_published(spark, more, "train")


def test_rows_other_than_the_manifest_says(spark, routed, tmp_path):
    path = published.publish(routed, str(tmp_path), WHEN, SPLITS)
    manifest = published.manifest_of(spark, path)
    manifest["splits"]["train"]["sum"] += 1
    file = next(f for f in os.listdir(f"{path}/_manifest") if f.startswith("part-"))
    os.remove(f"{path}/_manifest/.{file}.crc")
    with open(f"{path}/_manifest/{file}", "w") as f:
        f.write(json.dumps(manifest) + "\n")
    assert published.read_published(spark, path, "train").count() == manifest["splits"]["train"]["rows"]
    with pytest.raises(published.Incomplete, match="the manifest says"):
        published.read_published(spark, path, "train", verify=True)


def test_empty_split_and_empty_base(spark, routed, tmp_path):
    assert published.latest(spark, str(tmp_path / "none")) is None
    path = published.publish(routed.where(F.col("split") == "train"), str(tmp_path), WHEN, SPLITS, fmt="json", compression="gzip")
    assert published.read_published(spark, path, "test", verify=True).count() == 0
    assert published.read_published(spark, path, "train", verify=True).count() == routed.where(F.col("split") == "train").count()


@pytest.mark.parametrize("cycle,shards", [(1, 3), (2, 5), (4, 4), (3, 7)])
def test_interleaved_order(spark, tmp_path, cycle, shards):
    rows = spark.range(60).select("id", F.pmod(F.xxhash64("id"), F.lit(shards)).alias("s"))
    interleaved.write_shards(rows.where("s <> 1 OR id < 5"), str(tmp_path / "x"), shards, ["id"], F.col("s"))
    got = interleaved.read_interleaved(spark, str(tmp_path / "x"), "id long, s long", cycle).orderBy("position").collect()
    files = {}
    for r in sorted(rows.where("s <> 1 OR id < 5").collect()):
        files.setdefault(r.s, []).append(r.id)
    order, names = [], sorted(files)
    for at in range(0, len(names), cycle):
        group = [files[n] for n in names[at : at + cycle]]
        order += [f[i] for i in range(max(map(len, group))) for f in group if i < len(f)]
    assert [r.id for r in got] == order and [r.position for r in got] == list(range(len(order)))


def test_table_function_is_the_map(spark):
    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])

    def fn(text):
        data = json.loads(text)
        return [{"n": x, "t": str(x)} for x in data["xs"]] if isinstance(data, dict) else {"n": data, "t": "one"}

    texts = ['{"xs": [1, 2]}', '{"xs": []}', "{", "7", '{"ys": 1}', '"word"', '{"xs": [1, 9223372036854775808]}', "[1]", '{"xs": [9223372036854775807]}']
    lines = spark.createDataFrame([(t,) for t in texts], "value string")
    register_table_function(spark, "xs_of", fn, schema)
    lines.createOrReplaceTempView("xs_lines")
    called = spark.sql("SELECT q.* FROM xs_lines l, LATERAL xs_of(l.value) q")
    mapped = map_and_quarantine(lines, fn, schema, ["value"])
    as_rows = lambda df: sorted((tuple(r[c] for c in ("n", "t", "error_class", "raw", "output")) for r in df.collect()), key=str)
    assert called.columns == mapped.columns and as_rows(called) == as_rows(mapped)
    classes = sorted(r.error_class for r in mapped.where("error_class IS NOT NULL").collect())
    assert classes == ["KeyErrors", "TypeErrors", "TypeErrors", "TypeErrors", "ValueErrors"]
    assert mapped.where("output = -1").count() == 1 and mapped.agg(F.max("n")).first()[0] == 2**63 - 1


def test_plain_results_of_the_table_function_come_many_calls_at_a_time(spark):
    def fn(k):
        return [[{"n": 5.0, "t": "a"}, {"n": True, "t": None}], [], [{"n": 1, "t": "b"}, {"n": "c", "t": "c"}], {"n": None}][k % 4] if k < 4 else {"n": k, "t": str(k)}

    schema = T.StructType([T.StructField("n", T.LongType()), T.StructField("t", T.StringType())])
    register_table_function(spark, "plain_of", fn, schema)
    called = spark.sql("SELECT l.k, q.* FROM {lines} l, LATERAL plain_of(l.k) q", lines=spark.range(6).toDF("k"))
    plan = called._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPythonUDTF" in plan and "ArrowEvalPythonUDTF" not in plan
    got = sorted((r.k, r.output, r.n, r.t, r.error_class) for r in called.collect())
    assert got[0] == (0, 0, None, None, "TypeErrors")
    assert got[1:] == [(1, -1, None, None, None), (2, 0, None, None, "TypeErrors"), (3, 0, None, None, None), (4, 0, 4, "4", None), (5, 0, 5, "5", None)]
    whole = lambda k: [{"n": 5.0, "t": "a"}, {"n": k, "t": None}]
    register_table_function(spark, "whole_of", whole, schema)
    rows = spark.sql("SELECT q.n FROM {lines} l, LATERAL whole_of(l.k) q", lines=spark.range(1).toDF("k")).collect()
    assert sorted(r.n for r in rows) == [0, 5]


def test_published_rows_are_worked_out_once(spark, monkeypatch):
    from daybook.plans import registry_jobs

    seen, publish, conf = [], published.publish, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(conf)

    def noted(df, *args):
        seen.append(df.inputFiles())
        return publish(df, *args)

    monkeypatch.setattr(published, "publish", noted)
    assert registry_jobs.q_published_examples(spark, "/root/testdata/sf0.001").count() > 0
    assert len(seen) == 2 and all(files and not any("lineitem" in f for f in files) for files in seen)
    assert spark.conf.get(conf) == before


def test_learned_vectors(spark, tmp_path):
    sign = lambda c: F.pmod(F.col(c), F.lit(2)) * 2 - 1
    rows = spark.range(1200).select((F.col("id") % 40).alias("item_id"), F.expr("id div 40 % 12").alias("month"), *[F.rand(3).alias(c) for c in training.NUMERIC])
    rows = rows.withColumn(spec.TARGET, (sign("item_id") * sign("month")).cast("double"))
    machine = training.build_pipeline(model="fm", num_features=1 << 12, factors=2, max_iter=40, step_size=0.3).fit(rows)
    assert training.error_metrics(machine.transform(rows)).first().mse < 0.2
    machine.write().overwrite().save(f"{tmp_path}/m")
    loaded = PipelineModel.load(f"{tmp_path}/m")
    found = {c: {r[c]: r.vector for r in training.vectors(loaded, c, rows.select(c).distinct()).collect()} for c in ("item_id", "month")}
    assert len(found["item_id"]) == 40 and len(found["month"]) == 12 and all(len(v) == 2 for v in found["month"].values())
    dot = lambda i, m: sum(x * y for x, y in zip(found["item_id"][i], found["month"][m]))
    # from an even month to an odd one odd items gain, even items lose
    gain = lambda items: sum(dot(i, 1) - dot(i, 0) for i in items) / 20
    assert gain(range(1, 40, 2)) - gain(range(0, 40, 2)) > 2
    with pytest.raises(ValueError, match="linear, gbt or fm"):
        training.build_pipeline(model="lstm")


def test_stream_counts_validates_and_scores(spark, samples, tmp_path):
    base = str(tmp_path)
    dataset, model_dir = predict_plan.model_paths(base)
    run_train(spark, lineitem_sales(spark, SF_SMALL), dataset, "2000-01-01", fmt="parquet")
    predict_plan.run_fit(spark, dataset, model_dir, fmt="parquet", num_features=1 << 12)
    a, b = samples
    batches = [
        [json.dumps(a), "{broken", json.dumps([a, b])],
        [json.dumps(dict(b, cost="x")), json.dumps(dict(a, year_month="0000-05")), "[]"],
    ]
    os.makedirs(f"{base}/in")
    for k, lines in enumerate(batches):  # each start goes on where the last ended
        with open(f"{base}/in/f{k}", "w") as f:
            f.write("\n".join(lines) + "\n")
        start_prepare_stream(spark, f"{base}/in", f"{base}/out", dataset, model_dir, pred_date="2020-08-01").awaitTermination(120)
    counts = {r.stage: (r.n_elements, r.failed_elements) for r in stream_counts(spark, f"{base}/out").collect()}
    # sample A sells on day 31: no next step
    assert counts == {"parse": (5, 1), "prepare": (5, 1), "validate": (4, 0), "split": (4, 1), "score": (3, 2)}
    bad = spark.read.parquet(f"{base}/out/_quarantine").groupBy("stage").count().collect()
    assert {r.stage: r["count"] for r in bad} == {s: n for s, (_, n) in counts.items() if n}
    assert {r.split for r in spark.read.parquet(f"{base}/out/examples").collect()} == {"train", "test"}
    assert spark.read.parquet(f"{base}/out/predictions").count() == 1


def test_statistics_from_footers(spark, tmp_path):
    nan, inf = float("nan"), float("inf")
    tables = {
        "some": [(1.0, nan), (nan, 2.0), (3.0, None), (-2.5, -0.0)],
        "infinite": [(inf, 1.0), (-inf, 1.0)],
        "no number": [(nan, None), (None, nan)],
        "empty": [],
    }
    for name, values in tables.items():
        rows = spark.createDataFrame(values, "volume_ml double, pack_size double").repartition(3)
        rows.withColumns(footer_columns()).write.parquet(f"{tmp_path}/{name}")
        found = footer_stats(spark, f"{tmp_path}/{name}")
        plan = found._jdf.queryExecution().toString()
        assert "PushedAggregation: [MIN(fit_" in plan and "fit_volume_ml" in plan
        assert tuple(found.first()) == tuple(stats_frame(rows).first()), name
    assert "avro" in spark.conf.get("spark.sql.sources.useV1SourceList")  # the caller's session is as it was
    rows = spark.createDataFrame([(1.0, 1.0, None), (9.0, 9.0, "parse")], "volume_ml double, pack_size double, stage string")
    rows.withColumns(footer_columns(counts=F.col("stage").isNull())).write.parquet(f"{tmp_path}/counted")
    assert tuple(footer_stats(spark, f"{tmp_path}/counted").first()) == (1.0, 1.0, 1.0, 1.0)


def test_a_shard_may_be_many_files(spark, tmp_path):
    """no task sorts a whole shard, and positions are those of whole shards."""
    rows = spark.range(4000).selectExpr("id", "id % 2 AS s")
    interleaved.write_shards(rows, str(tmp_path / "x"), 2, ["id"], F.col("s"))
    assert len(list((tmp_path / "x").glob("shard=0/*.parquet"))) > 1
    got = interleaved.read_interleaved(spark, str(tmp_path / "x"), "id long, s long", 2).orderBy("position").collect()
    assert [(r.position, r.id) for r in got] == [(i, i) for i in range(4000)]
