"""Extraction over tables.

``template_extract`` reads the record back out of a synthetic note with
regular expressions: pure column expressions, JVM-side.

``sample_candidates`` asks a plug-in for several outputs a row, seeded by row and index.

``batch_extract`` is the plug-in path: a generator turns a batch of input
texts into raw output texts. It runs in ``mapInPandas`` (Arrow batches), the
generator is built once per partition; its texts are then parsed and rated like
any raw output. The default generator is the template
extractor written for pandas, so the pipeline runs without a model; a model
wrapper with the same ``__call__(pandas.DataFrame) -> pandas.Series`` shape
drops in.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

from pyspark.sql import Column, DataFrame, functions as F

from recordsmith.functions import rowjson as R
from recordsmith.functions import scoring as S
from recordsmith.operators.synth import REFUSAL_REASON
from recordsmith.ship import shipped

# Fixed value: the synthetic note layout, one group per record field.
NOTE_PATTERN = (r"^ED/Clinic note :: Pt (.+?), (\d+) y/o (\S+)\. Seen on (\S+) for (.+?)\. "
                r"Assessment mentions (.+?)\. Current meds: (.+?)\. Allergies: (.+?)\. "
                r"Vitals -> BP (\d+/\d+), HR (\d+), Temp (\d+\.\d+)F\. "
                r"Follow-up requested in (\d+) days\.")


def template_record(text: Column) -> Column:
    """The extraction target (STRUCT) read from a note; refusal when it does not match."""
    def g(i: int) -> Column:
        return F.regexp_extract(text, NOTE_PATTERN, i)
    meds = F.transform(F.split(g(7), "; "), lambda m: F.struct(
        F.regexp_extract(m, r"^(\S+) ", 1).alias("name"), F.regexp_extract(m, r"^\S+ (.*)$", 1).alias("dose")))
    record = F.struct(
        g(1).alias("patient_name"), g(2).cast("bigint").alias("age"), g(3).alias("sex"),
        g(4).alias("encounter_date"), g(5).alias("chief_complaint"),
        F.split(g(6), ", ").alias("diagnoses"), meds.alias("medications"),
        F.split(g(8), ", ").alias("allergies"),
        F.struct(g(9).alias("blood_pressure"), g(10).cast("bigint").alias("heart_rate"),
                 g(11).cast("double").alias("temperature_f")).alias("vitals"),
        g(12).cast("bigint").alias("follow_up_days"))
    matched = F.coalesce(text.rlike(NOTE_PATTERN), F.lit(False))
    return F.struct(
        matched.alias("can_extract"),
        F.when(~matched, F.lit(REFUSAL_REASON)).alias("refusal_reason"),
        F.when(matched, record).alias("record"))


def template_extract(df: DataFrame, text_col: str = "input_text", keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """C18 as a table: ``extracted_json`` compact, key order of the target schema."""
    return df.select(*keep, F.to_json(template_record(F.col(text_col)), {"ignoreNullFields": "false"})
                     .alias("extracted_json"))


class TemplateGenerator:
    """Default plug-in: reads the record out of each note with the same pattern."""

    def __init__(self) -> None:
        self._re = re.compile(NOTE_PATTERN)

    def _one(self, text) -> str:
        m = self._re.match(text or "")
        if not m:
            return json.dumps({"can_extract": False, "refusal_reason": REFUSAL_REASON, "record": None})
        g = m.groups()
        meds = [{"name": x.split(" ", 1)[0], "dose": x.split(" ", 1)[1] if " " in x else ""}
                for x in g[6].split("; ")]
        record = {"patient_name": g[0], "age": int(g[1]), "sex": g[2], "encounter_date": g[3],
                  "chief_complaint": g[4], "diagnoses": g[5].split(", "), "medications": meds,
                  "allergies": g[7].split(", "),
                  "vitals": {"blood_pressure": g[8], "heart_rate": int(g[9]), "temperature_f": float(g[10])},
                  "follow_up_days": int(g[11])}
        return json.dumps({"can_extract": True, "refusal_reason": None, "record": record})

    def __call__(self, batch):
        return batch["text"].map(self._one)


class DamageGenerator:
    """A plug-in for ``sample_candidates`` without a model: answers with its input, damaged in
    one of DAMAGES ways, as the row's seed says."""

    DAMAGES = ("clean", "prose", "trailing", "truncated", "non_object", "blank")

    def _one(self, text: str, seed: int) -> str:
        from recordsmith.sources import corpus as C
        kind = self.DAMAGES[seed % len(self.DAMAGES)]
        return {"clean": text, "prose": C.PROSE_HEAD + text + C.PROSE_TAIL, "trailing": text + C.TRAILER,
                "truncated": text[:-C.CUT_CHARS], "non_object": C.NON_OBJECT, "blank": C.BLANK}[kind]

    def __call__(self, batch):
        return [self._one(t or "", s) for t, s in zip(batch["text"], batch["seed"])]


def sample_candidates(df: DataFrame, generator_factory: Callable[[], Callable], k: int = 4, seed: int = 42,
                      text_col: str = "input_text", hint_col: str = "schema_hint", id_col: str = "id",
                      batch_rows: int = 64) -> DataFrame:
    """(id, candidate_index, text), ``k`` outputs of a generator for every row.

    The generator is built once a partition and called with batches of ``batch_rows`` requests
    across rows (text, schema_hint, candidate_index, seed). A request's seed is drawn from
    (seed, id, index) alone, so a generator that uses no other chance gives the same
    candidates at any partitioning and after any retry.
    """
    draw = F.conv(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col).cast("string"),
                                                F.col("candidate_index").cast("string"))), 1, 8), 16, 10).cast("bigint")
    requests = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(hint_col).alias("schema_hint"),
                         F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("candidate_index"))
    requests = requests.select("id", "text", "schema_hint", "candidate_index", draw.alias("seed"))

    def run(batches: Iterator) -> Iterator:
        generator = generator_factory()
        for pdf in batches:
            asked, texts = pdf.drop(columns="id"), []
            for at in range(0, len(pdf), batch_rows):
                texts.extend(generator(asked.iloc[at:at + batch_rows].reset_index(drop=True)))
            yield pdf[["id", "candidate_index"]].assign(text=texts)

    return shipped(requests).mapInPandas(run, f"id {dict(requests.dtypes)['id']}, candidate_index int, text string")


def batch_extract(df: DataFrame, text_col: str = "input_text", hint_col: str = "schema_hint",
                  id_col: str = "id", generator_factory: Callable[[], Callable] = TemplateGenerator) -> DataFrame:
    """``id, structured_json, confidence, raw_output`` for every row.

    Only ``id``, the text and the hint cross into Python; the generated text is parsed and
    rated as raw outputs are (``rated_outputs``).
    """
    def run(batches: Iterator) -> Iterator:
        gen = generator_factory()
        for pdf in batches:
            out = pdf[[id_col]].copy()
            out["raw_output"] = gen(pdf.rename(columns={text_col: "text", hint_col: "schema_hint"})).astype(str)
            yield out

    raw = shipped(df.select(id_col, text_col, hint_col)).mapInPandas(run, f"{id_col} string, raw_output string")
    return rated_outputs(raw, id_col)


def rated_outputs(df: DataFrame, id_col: str = "id") -> DataFrame:
    """(id, structured_json, confidence, raw_output) of a text column ``raw_output``."""
    parsed = df.select(id_col, "raw_output", R.document("raw_output").alias("_d"))
    return parsed.select(id_col, F.col("_d.canonical").alias("structured_json"), S.confidence_of(
        F.col("_d.kind").isNull(), F.col("_d.refused"), F.col("_d.populated")).alias("confidence"), "raw_output")
