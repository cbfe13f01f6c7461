"""Extraction round trip, batch = stream, and write/read round trips."""

import json
import random

import pytest
from pyspark.sql import functions as F

from recordsmith.operators import synth as SY
from recordsmith.operators.evaluate import eval_report, score_predictions
from recordsmith.operators.extract import batch_extract, template_extract
from recordsmith.sinks import writers as W
from recordsmith.sources import files as R
from recordsmith.streaming.extract_stream import extraction_columns, run_extract_stream


def test_template_round_trip_is_exact(spark):
    corpus = SY.build_corpus(spark, 300, num_partitions=3)
    extracted = template_extract(corpus)
    joined = corpus.select("id", F.to_json("target_json", {"ignoreNullFields": "false"}).alias("target_text")) \
        .join(extracted, "id")
    assert joined.where(F.col("target_text") != F.col("extracted_json")).count() == 0
    scored = score_predictions(joined.withColumnRenamed("extracted_json", "raw_output"))
    rep = eval_report(scored).first()
    assert (rep.samples, rep.json_validity_rate, rep.exact_match_accuracy, rep.field_level_f1,
            rep.refusal_correctness) == (300, 100.0, 100.0, 100.0, 100.0)


def test_batch_extract_plugin_matches_template(spark):
    corpus = SY.build_corpus(spark, 120, num_partitions=2)
    out = batch_extract(corpus)
    conf = {r.id: r.confidence for r in out.collect()}
    assert all(v == (0.99 if k.startswith("medical") else 0.92) for k, v in conf.items())
    ref = template_extract(corpus).select("id", F.parse_json("extracted_json").alias("v"))
    from recordsmith.functions.jsonparse import canonical_json
    want = {r.id: r.c for r in ref.select("id", canonical_json("v").alias("c")).collect()}
    assert {r.id: r.structured_json for r in out.collect()} == want


def test_stream_equals_batch(spark, tmp_dir):
    rows = [(1, '{"can_extract": false, "record": null}'), (2, 'x {"can_extract": true, "record": {"a": 1}} y'),
            (3, "garbage"), (4, "[1]")]
    src = f"{tmp_dir}/in"
    spark.createDataFrame(rows, "rid long, raw string").repartition(2).write.parquet(src)
    streamed = run_extract_stream(spark, src, "rid long, raw string", "rid", "raw")
    batch = extraction_columns(spark.read.parquet(src), "rid", "raw")
    assert sorted(streamed.collect()) == sorted(batch.collect())
    got = {r.rid: r.confidence for r in streamed.collect()}
    assert got == {1: 0.92, 2: 0.51, 3: 0.0, 4: 0.45}


def test_split_jsonl_round_trip_keeps_nulls(spark, tmp_dir):
    from recordsmith.operators.split import exact_split
    corpus = exact_split(SY.build_corpus(spark, 50, num_partitions=2)).drop("shuffle_key", "ordinal")
    W.write_splits(corpus, f"{tmp_dir}/splits")
    back = R.read_split_dir(spark, f"{tmp_dir}/splits")
    assert back.count() == 50
    assert back.where("split = 'test'").count() == 5
    ref = back.where("can_extract").select(F.to_json("target_json", {"ignoreNullFields": "false"}).alias("t")).first().t
    assert '"refusal_reason":null' in ref
    files = R.read_examples(spark, {"train": f"{tmp_dir}/splits/split=train"})
    assert files.count() == 40 and files.select("split").distinct().first().split == "train"


def test_dataset_card_and_candidates_document(spark, tmp_dir):
    W.write_dataset_card(SY.dataset_card(spark, 4000, 42), f"{tmp_dir}/card")
    card = spark.read.json(f"{tmp_dir}/card").first()
    assert (card.num_examples, card.seed, card.schema) == (4000, 42, "medical_intake_v1")
    cands = spark.createDataFrame([("a", 1, "y"), ("a", 0, "x"), ("b", 0, "z")],
                                  "id string, candidate_index int, text string")
    path = f"{tmp_dir}/cands.json"
    W.write_candidates_map(cands, path)
    back = R.read_candidates_map(spark, path)
    assert sorted(map(tuple, back.collect())) == [("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z")]


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("split", ["40b", "1k", "128m"])
def test_map_file_is_read_by_many_tasks(spark, tmp_dir, indent, split):
    r = random.Random(4)
    text = lambda: "".join(r.choice(['"', "\\", "a", "é", "😀", "{", "}", "[", "]", ":", ",", "\n", " ", "\u0001"]) for _ in range(r.randint(0, 12)))
    doc = {f"{k}{text()}": [text() for _ in range(r.choice([0, 1, 2, 5]))] for k in range(60)}
    raw = json.dumps(doc, indent=indent, ensure_ascii=indent is None)
    raw = raw[:-1] + ', "twice": ["x"], "twice": ["y", "z"]}'
    with open(f"{tmp_dir}/map.json", "w", encoding="utf-8") as fh:
        fh.write(raw)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", split)
        spark.conf.set("spark.sql.files.openCostInBytes", "1")
        rows = R.read_candidates_map(spark, f"{tmp_dir}/map.json").collect()
        parts = spark.read.option("lineSep", '"').text(f"{tmp_dir}/map.json").rdd.getNumPartitions()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert parts > 20 or split != "40b"
    want = json.loads(raw)
    assert sorted(map(tuple, rows)) == sorted((i, k, t) for i, texts in want.items() for k, t in enumerate(texts))


def test_map_folder_is_one_document(spark, tmp_dir):
    rows = [(f"id {k} \"é\"", j, f"text {j} \\ {k}\n") for k in range(50) for j in range(k % 4)]
    cands = spark.createDataFrame(rows, "id string, candidate_index int, text string").repartition(6)
    W.write_candidates_map(cands, f"{tmp_dir}/map")
    whole = "".join(r.value + "\n" for r in spark.read.text(f"{tmp_dir}/map").withColumn("f", F.col("_metadata.file_name"))
                    .withColumn("i", F.monotonically_increasing_id()).orderBy("f", "i").collect())
    want = {}
    for i, _, t in sorted(rows):
        want.setdefault(i, []).append(t)
    assert json.loads(whole) == want and whole.isascii()
    assert sorted(map(tuple, R.read_candidates_map(spark, f"{tmp_dir}/map").collect())) == sorted(rows)


def test_rerun_replaces_one_split_only(spark, tmp_dir):
    df = spark.range(30).select(F.col("id"), F.lit("ü").alias("t"), F.lit(None).cast("string").alias("n"),
                                F.when(F.col("id") < 20, "train").otherwise("val").alias("split"))
    W.write_splits(df, f"{tmp_dir}/s")
    W.write_splits(df.where("split = 'val'").withColumn("t", F.lit("new")), f"{tmp_dir}/s")
    back = R.read_jsonl(spark, f"{tmp_dir}/s", "id long, t string, n string", "split string")
    assert {(r.split, r.t): r.n for r in back.groupBy("split", "t").agg(F.count("*").alias("n")).collect()} == {("train", "ü"): 20, ("val", "new"): 10}
    plan = back.where("split = 'val'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(split" in plan
    line = spark.read.text(f"{tmp_dir}/s/split=train").first().value
    assert line.isascii() and "\\u00fc" in line and '"n":null' in line


def test_eval_report_files(spark, tmp_dir):
    import json
    for name, v in (("baseline_eval", 45.0), ("sft_eval", 91.0)):
        with open(f"{tmp_dir}/{name}.json", "w") as fh:
            json.dump({"samples": 400, "json_validity_rate": v, "exact_match_accuracy": 1.0,
                       "field_level_f1": 2.0, "refusal_correctness": 3.0, "predictions": []}, fh, indent=2)
    rep = R.read_eval_reports(spark, [f"{tmp_dir}/baseline_eval.json", f"{tmp_dir}/sft_eval.json"])
    assert {r.stage: r.json_validity_rate for r in rep.collect()} == {"baseline_eval": 45.0, "sft_eval": 91.0}


def test_stream_reads_a_table_of_several_files(spark, tmp_path):
    from recordsmith.plans.catalog import queries
    rows = spark.createDataFrame([(k, '{"k": %d}' % k) for k in range(30)], "event_id long, props string")
    rows.repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    out = queries()["stream_extract"](spark, str(tmp_path)).collect()
    assert sorted(r["event_id"] for r in out) == list(range(30))
    assert all(r["structured_json"] == '{"k":%d}' % r["event_id"] for r in out)


def test_sampled_candidates_do_not_depend_on_partitions(spark):
    from recordsmith.operators.extract import DamageGenerator, sample_candidates
    df = spark.createDataFrame([(f"id-{k}", f'{{"n": {k}, "text": "some words"}}', "h") for k in range(100)] + [("none", None, None)],
                               "id string, input_text string, schema_hint string")
    got = [sorted(map(tuple, sample_candidates(df.repartition(n), DamageGenerator, k=3, batch_rows=b).collect()))
           for n, b in ((1, 64), (7, 5))]
    assert got[0] == got[1] and len(got[0]) == 303
    assert len({t for _, _, t in got[0]}) > 100 and {t for i, _, t in got[0] if i == "id-5"} != {t for i, _, t in got[0] if i == "id-6"}
    assert sample_candidates(df.limit(0), DamageGenerator).count() == 0


def test_generator_is_built_once_a_partition(spark, tmp_dir):
    from recordsmith.operators.extract import sample_candidates

    def factory():
        import uuid
        made = uuid.uuid4().hex
        return lambda batch: [f"{made} {len(batch)}"] * len(batch)

    df = spark.range(40).select(F.col("id"), F.lit("x").alias("input_text"), F.lit("h").alias("schema_hint")).coalesce(1)
    texts = [r.text.split() for r in sample_candidates(df, factory, k=4, batch_rows=50).collect()]
    assert len({made for made, _ in texts}) == 1 and {n for _, n in texts} == {"50", "10"}


def test_stream_of_notes_resumes_after_a_killed_batch(spark, tmp_dir):
    from recordsmith.streaming.extract_stream import note_columns, start_extract_stream
    notes = SY.build_corpus(spark, 60, num_partitions=1).select("id", "input_text").collect()
    schema = "id string, input_text string"

    def file(n, rows):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(f"{tmp_dir}/in/{n}")

    def stream(columns):
        return start_extract_stream(spark, f"{tmp_dir}/in/*", schema, "id", "input_text", f"{tmp_dir}/out", f"{tmp_dir}/ckpt",
                                    fmt="json", max_files_per_trigger=1, columns=columns)

    file(1, notes[:20])
    stream(note_columns).awaitTermination()
    file(2, notes[20:40])
    file(3, notes[40:])

    def killed(df, id_col, text_col):                        # fails in the batch of the third file
        bad = F.when(F.col(id_col) == notes[40].id, F.raise_error(F.lit("killed")).cast("string")).otherwise(F.col(text_col))
        return note_columns(df.withColumn(text_col, bad), id_col, text_col)

    q = stream(killed)
    with pytest.raises(Exception, match="killed"):
        q.awaitTermination()
    stream(note_columns).awaitTermination()
    got = spark.read.parquet(f"{tmp_dir}/out").collect()
    assert sorted(r.id for r in got) == sorted(n.id for n in notes)
    want = note_columns(spark.createDataFrame(notes, schema), "id", "input_text").collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))
