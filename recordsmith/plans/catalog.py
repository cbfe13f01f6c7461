"""Registered queries: ``name -> (spark, sf_dir) -> DataFrame``.

Each query reads the driver tables (or data Spark derives from them) in
full. The matching DuckDB SQL lives in ``recordsmith.plans.oracles``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from recordsmith.functions import jsonparse as J
from recordsmith.functions import rowjson as R
from recordsmith.operators import chat as CH
from recordsmith.operators import extract as EX
from recordsmith.operators import pairs as PR
from recordsmith.operators import report as RP
from recordsmith import schemas as SCH
from recordsmith.operators import split as SP
from recordsmith.functions.text import json_string
from recordsmith.operators.conform import Maybe, nested_conformance
from recordsmith.operators import synth as SY
from recordsmith.operators.evaluate import eval_report as _eval_report
from recordsmith.operators.evaluate import join_predictions, report_without_detail, score_predictions
from recordsmith.operators.flatten import flatten_json as _flatten_json
from recordsmith.operators.jsonsafe import json_safe
from recordsmith.operators.parallel import ensure_parallelism, spread
from recordsmith.operators.score_long import score_documents_long, score_long as score_rows
from recordsmith.session import checkpoint_root, configure
from recordsmith.sinks.writers import split_summary, write_candidates_map, write_reports, write_splits
from recordsmith.sources.corpus import order_candidates, order_corpus, order_source
from recordsmith.sources.files import read_candidates_map, read_eval_reports, read_jsonl
from recordsmith.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}

# Kinds of the order-record members, for the schema-conformance check.
ORDER_RECORD_FIELDS = {
    "order_id": "integer", "customer": "string", "order_date": "string", "priority": "string",
    "total_cents": "integer", "tags": "array", "parties": "array", "amounts": "object",
}


# The same and what is inside them, for the check of every level.
ORDER_SCHEMA = {
    "can_extract": "boolean", "refusal_reason": "string or null",
    "record": Maybe({
        "order_id": "integer", "customer": "string", "order_date": "string", "priority": "string",
        "total_cents": "integer", "tags": ["string"], "parties": [{"name": "string", "nation": "string"}],
        "amounts": {"total_cents": "integer", "balance_cents": "integer"},
    }),
}


def register(fn: Query) -> Query:
    def wrapped(spark: SparkSession, sf_dir: str) -> DataFrame:
        configure(spark)
        return fn(spark, sf_dir)
    wrapped.__name__ = fn.__name__
    wrapped.__doc__ = fn.__doc__
    REGISTRY[fn.__name__] = wrapped
    return wrapped


def _scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_predictions(order_corpus(spark, sf_dir), keep=("id",))


def _raw_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_corpus(spark, sf_dir).select("id", "raw_output")


# ------------------------------------------------------------ 1. evaluation


@register
def eval_report(spark, sf_dir):
    """Validity / exact / field F1 / refusal over the whole order corpus."""
    return _eval_report(_scored(spark, sf_dir))


@register
def eval_report_joined(spark, sf_dir):
    """The same report with predictions and examples as tables of their own."""
    corpus = order_corpus(spark, sf_dir)
    joined = join_predictions(corpus.select("id", "raw_output"), corpus.select("id", "target_text"))
    return _eval_report(score_predictions(joined, keep=("id",)))


@register
def json_safe_rows(spark, sf_dir):
    """Orders and their lines as JSON text, dates and timestamps in ISO form."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = (table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(F.struct(
        "l_linenumber", "l_shipdate", F.to_date("l_shipdate").alias("ship_day")))).alias("lines")))
    both = orders.join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    safe = json_safe(both.select("o_orderkey", "o_orderdate", "lines"))
    shown = F.array_join(F.transform("lines", lambda x: F.concat_ws(
        " ", x["l_linenumber"].cast("string"), x["l_shipdate"], x["ship_day"])), ",")
    return safe.select("o_orderkey", "o_orderdate", F.coalesce(shown, F.lit("")).alias("lines"))


@register
def prediction_detail(spark, sf_dir):
    """Per-row parsed output, target and the four scores."""
    return _scored(spark, sf_dir).select(
        "id", "raw_output", "parsed_output", "target_json", "json_valid", "exact_match", "field_f1", "refusal_correct")


# --------------------------------------------------------------- 2. parsing


@register
def parse_json_block(spark, sf_dir):
    """Strict two-attempt parse of every raw output."""
    p = _raw_outputs(spark, sf_dir).select("id", R.document("raw_output").alias("_d"))
    return p.select("id", F.col("_d.kind").isNotNull().alias("json_valid"),
                    F.col("_d.kind").alias("parsed_kind"), F.col("_d.canonical").alias("parsed_output"))


@register
def canonical_json(spark, sf_dir):
    """Canonical text of every ``events.props`` document."""
    ev = ensure_parallelism(table(spark, sf_dir, "events").select("event_id", "props"), "event_id")
    parsed = ev.select("event_id", J.strict_parse("props").alias("v"))
    return parsed.select("event_id", J.canonical_json("v").alias("canonical"))


@register
def flatten_json(spark, sf_dir):
    """(id, path, literal) leaves of every parsed raw output."""
    return _flatten_json(_raw_outputs(spark, sf_dir), "id", "raw_output")


@register
def flatten_event_props(spark, sf_dir):
    """C3 over ``events.props``."""
    ev = ensure_parallelism(table(spark, sf_dir, "events").select("event_id", "props"), "event_id")
    parsed = ev.select("event_id", J.strict_parse("props").alias("v"))
    return _flatten_json(parsed, "event_id", "v")


# --------------------------------------------------------------- 3. scoring


@register
def field_f1(spark, sf_dir):
    """C4: field-level F1 per row."""
    return _scored(spark, sf_dir).select("id", "field_f1")


@register
def refusal_correct(spark, sf_dir):
    """Refusal correctness per row (Python equality rules)."""
    return _scored(spark, sf_dir).select("id", "refusal_correct")


@register
def extract_response(spark, sf_dir):
    """structured_json, confidence, raw_output per raw output."""
    return EX.rated_outputs(_raw_outputs(spark, sf_dir))


@register
def schema_check(spark, sf_dir):
    """Does each parsed output match the record schema exactly."""
    return _raw_outputs(spark, sf_dir).select("id", R.conformance("raw_output", ORDER_RECORD_FIELDS).alias("schema_ok"))


@register
def schema_nested(spark, sf_dir):
    """C21 at every level: faults of each parsed output against the order schema."""
    return nested_conformance(_raw_outputs(spark, sf_dir), "id", "raw_output", ORDER_SCHEMA)


@register
def score_long(spark, sf_dir):
    """Field F1 of the order corpus over leaf tables."""
    return score_documents_long(order_corpus(spark, sf_dir), "id", "raw_output", "target_text")


@register
def score_long_events(spark, sf_dir):
    """The same over ``events``: one document per event type, its leaves the members of all
    its events' props, compared with the event numbers modulo 100."""
    ev = ensure_parallelism(table(spark, sf_dir, "events").select("event_id", "event_type", "props"), "event_id")
    parsed = ev.select("event_type", "event_id", J.strict_parse("props").alias("v"))
    at = F.col("event_id").cast("string")
    leaves = (parsed.select("event_type", "event_id", J.flatten_leaves("v").alias("_l"))
              .select("event_type", "event_id", F.inline_outer("_l")).where(F.col("path").isNotNull()))
    pred = leaves.select(F.col("event_type").alias("id"), F.concat(at, F.lit("."), "path").alias("path"), "literal")
    target = ev.select(F.col("event_type").alias("id"), F.concat(at, F.lit(".k")).alias("path"),
                       F.pmod("event_id", F.lit(100)).cast("string").alias("literal"))
    ids = ev.select(F.col("event_type").alias("id")).distinct().withColumn("json_valid", F.lit(True))
    return score_rows(ids, pred, target)


@register
def number_kinds(spark, sf_dir):
    """Canonical text of numbers as they stand in the text: integers beyond 64 bits,
    exponents, negative zeros, fractions."""
    o = spread(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), "o_orderkey")
    o = o.select("o_orderkey", (F.col("o_orderkey") + 1).alias("next"), "o_custkey", F.round(F.col("o_totalprice") * 100).cast("bigint").alias("c"))
    n = {k: F.coalesce(F.col(v).cast("string"), F.lit("0")) for k, v in (("key", "next"), ("cust", "o_custkey"), ("cents", "c"))}
    text = F.concat(F.lit('{"big":'), n["key"], F.lit('00000000000000000000,"price":'), n["cents"], F.lit('E-2,"tiny":'), n["cust"],
                    F.lit('e-12,"huge":'), n["cents"], F.lit('.5E+17,"whole":'), n["cust"], F.lit('.0,"list":[-0.0,-0,'),
                    n["key"], F.lit("e3]}"))
    return o.select("o_orderkey", text.alias("t")).select("o_orderkey", R.document("t", "strict")["canonical"].alias("canonical"))


@register
def ascii_texts(spark, sf_dir):
    """Documents and turns as ASCII JSON strings; the digest and the length of each."""
    docs = table(spark, sf_dir, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), F.lit(0).cast("bigint").alias("turn"), "text")
    turns = table(spark, sf_dir, "conversations").select(F.lit("turn").alias("kind"), F.col("conv_id").alias("id"), F.col("turn").cast("bigint").alias("turn"), "text")
    texts = docs.unionByName(turns).select("kind", "id", "turn", json_string(F.col("text")).alias("j"))
    plain = texts.select("kind", "id", "turn", J.ascii_escape("j").alias("j"))
    return plain.select("kind", "id", "turn", F.md5("j").alias("digest"), F.length("j").cast("bigint").alias("chars"))


# ------------------------------------------------------------ 4. corpus


def _index(spark, sf_dir) -> DataFrame:
    """The synthetic corpus has one example per order, indexed by the order key."""
    return SY.corpus_index(ensure_parallelism(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("idx")), "idx"))


def _split_index(spark, sf_dir) -> DataFrame:
    """The index in its shuffled order, split by position; no text is made before it."""
    return SP.exact_split(_index(spark, sf_dir))


def _document_splits(spark, sf_dir) -> DataFrame:
    """``documents`` split by position in the order of the md5 of the id."""
    docs = ensure_parallelism(table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    return SP.boundary_split(docs.withColumn("_h", SY.shuffle_key(SY.DEFAULT_SEED, "doc_id")), "_h", "doc_id").drop("_h")


def _target_text(df: DataFrame) -> DataFrame:
    return df.withColumn("target_json", F.to_json("target_json", {"ignoreNullFields": "false"}))


_EXAMPLE_COLS = ["id", "input_text", "schema_hint", "target_json", "can_extract", "domain"]


@register
def synth_notes(spark, sf_dir):
    """Medical notes and targets, one per order that is no refusal."""
    return _target_text(SY.build_notes(_index(spark, sf_dir).where("NOT refusal")))


@register
def synth_refusals(spark, sf_dir):
    """Refusal examples, of the last ``int(n * 0.12)`` orders by key."""
    return _target_text(SY.build_refusals(_index(spark, sf_dir).where("refusal")))


@register
def split_corpus(spark, sf_dir):
    """The shuffled corpus with its position and split."""
    rows = SY.examples(_split_index(spark, sf_dir), keep=("ordinal", "split"))
    return _target_text(rows).select(*_EXAMPLE_COLS, "ordinal", "split")


@register
def split_counts(spark, sf_dir):
    """Rows per split of ``documents``."""
    return split_summary(_document_splits(spark, sf_dir))


@register
def split_documents(spark, sf_dir):
    """W2/U3 over a table of texts: the split of every document, and its length."""
    return _document_splits(spark, sf_dir).select("doc_id", "split", F.length("text").cast("bigint").alias("chars"))


@register
def eval_subset(spark, sf_dir):
    """the evaluator's ``--limit``: first 400 test rows in file order."""
    test = _split_index(spark, sf_dir).where(F.col("split") == "test")
    rows = SY.examples(SP.head_by_ordinal(test, 400), keep=("ordinal",))
    return _target_text(rows).select("id", "ordinal", "target_json")


@register
def first_example(spark, sf_dir):
    """Preview of the first training row as its JSONL line."""
    train = _split_index(spark, sf_dir).where(F.col("split") == "train")
    first = SY.examples(SP.head_by_ordinal(train, 1))
    line = first.select("id", F.to_json(F.struct(*_EXAMPLE_COLS), {"ignoreNullFields": "false"}).alias("line"))
    return line.select("id", J.ascii_escape("line").alias("line"))


# ------------------------------------------------------------- 5. rendering


def _conversations(spark, sf_dir):
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")


@register
def chat_render(spark, sf_dir):
    """Every conversation rendered with the chat template."""
    return CH.render_conversations(_conversations(spark, sf_dir))


@register
def chat_prompt(spark, sf_dir):
    """C11: the same with the generation suffix."""
    return CH.render_conversations(_conversations(spark, sf_dir), add_generation_prompt=True)


@register
def tool_chat_render(spark, sf_dir):
    """Conversations with tool turns, built from the event log."""
    return CH.render_conversations(CH.events_as_turns(table(spark, sf_dir, "events")))


@register
def sft_text(spark, sf_dir):
    """Training text of every training document; the target is its language,
    source and first line, ASCII-escaped."""
    train = _document_splits(spark, sf_dir).where(F.col("split") == "train")
    target = F.to_json(F.struct("lang", "source", F.substring_index(F.coalesce("text", F.lit("")), "\n", 1).alias("opening")),
                       {"ignoreNullFields": "false"})
    return CH.sft_text(train.select(F.col("text").alias("input_text"), F.col("lang").alias("schema_hint"),
                                    target.alias("target_json")))


@register
def user_prompt(spark, sf_dir):
    """The user prompt of every example of the corpus, and of every document with its source
    as the hint."""
    from recordsmith.functions.prompts import user_prompt as _up
    corpus = SY.examples(_index(spark, sf_dir)).select("id", _up(F.col("input_text"), F.col("schema_hint")).alias("prompt"))
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("document-"), F.col("doc_id").cast("string")).alias("id"), _up(F.col("text"), F.col("source")).alias("prompt"))
    return corpus.unionByName(docs)


@register
def inference_prompts(spark, sf_dir):
    """C11: what a model is given for every first user turn: system and user turn, and the
    generation suffix."""
    from recordsmith.functions.prompts import DEFAULT_SCHEMA_HINT, inference_prompt
    turns = table(spark, sf_dir, "conversations").where("role = 'user'").select("conv_id", "turn", "text")
    first = turns.groupBy("conv_id").agg(F.min_by("text", "turn").alias("text"))
    return first.select("conv_id", inference_prompt(F.col("text"), F.lit(DEFAULT_SCHEMA_HINT)).alias("prompt"))


# ------------------------------------------------------------------ 6. pairs


def _candidates(spark, sf_dir, *keep):
    return order_candidates(order_source(spark, sf_dir), keep=keep)


def _judged(spark, sf_dir, keep=(), lists=False):
    """Candidates made, scored and judged next to their target: the source is built once, and
    the only exchange behind it is the one by id (a separately sourced candidate table joins
    on id instead)."""
    cands = order_candidates(order_source(spark, sf_dir), keep=("target_text", *keep))
    return PR.rule_judge(PR.score_candidates(cands, ORDER_RECORD_FIELDS, keep=keep), keep, lists)


def _pairs(spark, sf_dir, keep=()):
    carried = ("input_text", "schema_hint", *keep)
    judged = _judged(spark, sf_dir, carried, lists=True)
    parsed, _ = PR.parse_verdicts(PR.verdict_text(judged, (*carried, "candidates")), keep=(*carried, "candidates"))
    return PR.pairs_of(parsed, keep=keep)


@register
def candidates_long(spark, sf_dir):
    """C19/S3 long form: k candidates per example."""
    return _candidates(spark, sf_dir)


@register
def sampled_candidates(spark, sf_dir):
    """K outputs per order from a generator plug-in, seeded by id and index."""
    src = order_source(spark, sf_dir).select("id", "target_text", "schema_hint")
    return EX.sample_candidates(src, EX.DamageGenerator, text_col="target_text")


@register
def candidate_lists(spark, sf_dir):
    """Candidates collected per id, in index order."""
    lists = PR.candidate_lists(_candidates(spark, sf_dir))
    return lists.select("id", F.size("candidates").cast("bigint").alias("n_candidates"),
                        F.to_json("candidates").alias("candidates_json"))


def _judge_rows(spark, sf_dir):
    same = ("input_text", "schema_hint", "target_text")
    return PR.candidate_lists(_candidates(spark, sf_dir, *same), same)


@register
def judge_payload(spark, sf_dir):
    """The judge request body per example."""
    return PR.judge_payload(_judge_rows(spark, sf_dir))


@register
def judge_payload_pretty(spark, sf_dir):
    """The request body as it is sent, indented by two, ASCII only."""
    return PR.judge_request(_judge_rows(spark, sf_dir)).select("id", F.col("user").alias("payload"))


@register
def rank_candidates(spark, sf_dir):
    """Best and worst candidate by the judge criteria."""
    return _judged(spark, sf_dir)


@register
def judge_parse(spark, sf_dir):
    """Verdict texts parsed back to indexes and reason."""
    good, _bad = PR.parse_verdicts(PR.verdict_text(_judged(spark, sf_dir)), on_error="quarantine")
    return good


@register
def preference_pairs(spark, sf_dir):
    """Prompt, chosen and rejected text per example."""
    return _pairs(spark, sf_dir)


@register
def pair_split(spark, sf_dir):
    """First int(n*0.8) pairs in input order are train, the rest val."""
    # ``key`` (the order key) is the input ordinal of each pair; every order has a pair, so
    # the split needs no candidate to be scored.
    src = order_source(spark, sf_dir).select("id", "key")
    return SP.pair_split(src, ordinal_col="key").select("id", "split")


def _written_verdicts(spark, sf_dir) -> str:
    """Verdicts on the orders, one in seven of them broken in one of four ways, read and
    written by state."""
    key = F.col("o_orderkey")
    sound = F.concat(F.lit('{"chosen_index":'), F.pmod(key, F.lit(4)).cast("string"), F.lit(',"rejected_index":'),
                     F.pmod(key + 1, F.lit(4)).cast("string"), F.lit(',"reason":"'), F.coalesce("o_orderpriority", F.lit("")), F.lit('"}'))
    kind = F.when(F.pmod(key, F.lit(7)) == 3, F.pmod(key, F.lit(4))).otherwise(F.lit(-1))
    text = (F.when(kind == 0, F.regexp_replace(sound, r"[{}]", "")).when(kind == 1, F.regexp_replace(sound, ",.*", "}"))
            .when(kind == 2, F.regexp_replace(sound, r":([0-9])", ':"$1"')).when(kind == 3, F.substring(sound, 1, 20))
            .otherwise(F.concat(F.lit("Verdict: "), sound, F.lit(" -- done"))))
    texts = table(spark, sf_dir, "orders").select(F.format_string("order-%d", key).alias("id"), text.alias("output_text"))
    path = f"{checkpoint_root(spark)}/verdicts/{uuid.uuid4().hex}"
    PR.write_verdicts(texts, path)
    return path


@register
def verdicts_good(spark, sf_dir):
    """F8: verdicts that could be read, from the side output's good folder."""
    return PR.read_verdicts(spark, _written_verdicts(spark, sf_dir), "good").drop("output_text")


@register
def verdicts_bad(spark, sf_dir):
    """F8: the quarantined verdict texts, from the bad folder of the same kind of pass."""
    return PR.read_verdicts(spark, _written_verdicts(spark, sf_dir), "bad").select("id", "output_text")


# ----------------------------------------------------------------- 7. reports


def _stage_reports(spark, sf_dir):
    """One evaluation report per candidate position, read as a model stage."""
    scored = PR.score_candidates(_candidates(spark, sf_dir, "target_text"), {})
    rep = _eval_report(scored, group_cols=("candidate_index",))
    return rep.select(F.concat(F.lit("stage_"), F.col("candidate_index").cast("string")).alias("stage"),
                      F.col("candidate_index").alias("stage_no"), *rep.columns[1:])


@register
def stage_report(spark, sf_dir):
    """The four metrics (and samples) per stage."""
    return _stage_reports(spark, sf_dir)


@register
def stage_compare(spark, sf_dir):
    """Stage reports as a long (stage, metric, value) table."""
    rep = _stage_reports(spark, sf_dir)
    return RP.unpivot_metrics(rep.select("stage", "stage_no", *SCH.METRIC_NAMES))


@register
def stage_delta(spark, sf_dir):
    """Change of each metric from the previous stage."""
    rep = _stage_reports(spark, sf_dir)
    return RP.stage_delta(RP.unpivot_metrics(rep.select("stage", "stage_no", *SCH.METRIC_NAMES)))


def _metric_log(spark, sf_dir):
    """The event log read as a metric log: run = user, step = event, metric = value."""
    return table(spark, sf_dir, "events").select("user_id", "event_id", "value")


@register
def best_checkpoint(spark, sf_dir):
    """A10: per run, the step with the lowest metric (ties: lowest step)."""
    return RP.best_checkpoint(_metric_log(spark, sf_dir), "user_id", "event_id", "value")


@register
def running_best(spark, sf_dir):
    """Lowest metric so far at every step of every run."""
    return RP.running_best(_metric_log(spark, sf_dir), "user_id", "event_id", "value")


def _folder(spark, name: str) -> str:
    return f"{checkpoint_root(spark)}/{name}/{uuid.uuid4().hex}"


@register
def documents_files(spark, sf_dir):
    """Documents written as JSONL by split, the val split written again, and
    the train split read back; the digest of every text."""
    path = _folder(spark, "splits")
    docs = _document_splits(spark, sf_dir)
    write_splits(docs, path)
    write_splits(docs.where("split = 'val'").withColumn("text", F.lit("rewritten")), path)
    back = read_jsonl(spark, path, "doc_id BIGINT, text STRING, lang STRING, source STRING", "split STRING")
    return back.where("split <> 'test'").select("doc_id", "split", "lang", "source", F.md5("text").alias("digest"))


@register
def candidates_files(spark, sf_dir):
    """S3/K5: candidates written as one JSON object over many files and read back."""
    path = _folder(spark, "candidates")
    write_candidates_map(_candidates(spark, sf_dir), path, compression="snappy")
    spark._jvm.System.gc()          # Spark removes the shuffle files of the write before the read makes its own
    return read_candidates_map(spark, path)


@register
def stage_delta_files(spark, sf_dir):
    """A report document per candidate position, read back with the stage
    from the file's name, and the change of each metric."""
    path = _folder(spark, "reports")
    reports = _stage_reports(spark, sf_dir)
    write_reports(report_without_detail(reports.withColumn("predictions", F.lit(None).cast("string"))).drop("stage_no"), path)
    back = RP.stage_metrics(read_eval_reports(spark, [path]))
    ordered = back.withColumn("stage_no", F.regexp_extract("stage", r"(\d+)$", 1).cast("int"))
    return RP.stage_delta(RP.unpivot_metrics(ordered.select("stage", "stage_no", *SCH.METRIC_NAMES)))


def _trainer_states(spark, sf_dir) -> DataFrame:
    """The event log as trainer states, one document per user and day: events with an odd number
    are training rows, the others evaluations, and the last one is the summary."""
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", F.date_format("ts", "yyyy-MM-dd").alias("day"), "value")
    last = F.max("event_id").over(Window.partitionBy("user_id", "day"))
    odd, end = F.pmod("event_id", F.lit(2)) == 1, F.col("event_id") == last
    entry = F.struct(F.col("event_id").alias("step"), F.when(~end & odd, F.col("value")).alias("loss"),
                     F.when(~end & ~odd, F.col("value")).alias("eval_loss"), F.when(end, F.col("value")).alias("train_runtime"))
    return ev.withColumn("e", entry).groupBy("user_id", "day").agg(
        F.max("event_id").alias("global_step"), F.sort_array(F.collect_list("e")).alias("log_history"))


@register
def train_log(spark, sf_dir):
    """Trainer-state documents written, read back with the schema that joins all their
    rows' keys, and taken apart into training, evaluation and summary rows."""
    path = _folder(spark, "states")
    _trainer_states(spark, sf_dir).drop("user_id", "day").write.mode("overwrite").json(path)    # absent keys stay absent
    state = spark.read.schema(SCH.TRAINER_STATE).json(path)
    logs = RP.log_tables(state)
    parts = [logs[k].select(F.lit(k).alias("part"), "step", F.col(c).alias("value")) for k, c in
             (("train", "loss"), ("eval", "eval_loss"), ("final", "train_runtime"))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


# -------------------------------------------------------------- 8. extraction


@register
def template_extract(spark, sf_dir):
    """Records read back out of every synthetic note (round trip to the target)."""
    return EX.template_extract(SY.examples(_index(spark, sf_dir)))


@register
def batch_extract(spark, sf_dir):
    """Plug-in generator over every example, then parse and confidence."""
    return EX.batch_extract(SY.examples(_index(spark, sf_dir))).select("id", "structured_json", "confidence")


# -------------------------------------------------------------- 10. streaming


@register
def stream_extract(spark, sf_dir):
    """Events.props arriving as files, parsed and scored by a stream."""
    from recordsmith.streaming.extract_stream import run_extract_stream
    schema = table(spark, sf_dir, "events").schema
    # As a glob, so that a table of one file and a folder of files are both taken whole.
    out = run_extract_stream(spark, f"{sf_dir.rstrip('/')}/events.[p]arquet", schema, "event_id", "props")
    return out.select("event_id", "structured_json", "confidence")


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
