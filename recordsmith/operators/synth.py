"""Seeded synthetic corpus: medical notes, refusals, their mix.

Rows come from ``spark.range`` split into many partitions; every value is a
pure function of (seed, idx, field), so the corpus is identical for any
partitioning and any retry. The shuffle order is a column (``shuffle_key``),
not a physical sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from recordsmith.functions import draws as D
from recordsmith.functions.prompts import DEFAULT_SCHEMA_HINT

# Vocabularies of the synthetic notes.
NAMES = ["Ava Johnson", "Noah Martinez", "Mia Patel", "Liam Chen", "Sophia Williams",
         "Ethan Garcia", "Olivia Nguyen", "Lucas Brown", "Emma Lopez", "Elijah Davis"]
SEXES = ["female", "male"]
COMPLAINTS = ["shortness of breath", "persistent cough", "headache", "abdominal pain",
              "fatigue", "chest tightness", "dizziness", "low back pain"]
DIAGNOSES = ["hypertension", "viral upper respiratory infection", "migraine", "type 2 diabetes",
             "asthma exacerbation", "gastroenteritis", "anxiety", "lumbar strain"]
MEDICATIONS = [("lisinopril", "10 mg daily"), ("metformin", "500 mg twice daily"),
               ("albuterol", "2 puffs as needed"), ("ibuprofen", "400 mg every 8 hours as needed"),
               ("sertraline", "50 mg daily"), ("ondansetron", "4 mg every 8 hours as needed")]
ALLERGIES = ["penicillin", "sulfa", "latex", "none known", "peanuts"]
REFUSAL_TEXTS = [
    "Marketing brainstorm notes for next quarter campaign. No patient details included.",
    "Shopping list: bananas, oat milk, detergent, printer ink. Need to reorder by Friday.",
    "Project retro summary: team velocity improved after reducing weekly meetings.",
    "Travel itinerary draft with flight numbers and hotel check-in instructions.",
]
FOLLOW_UP_DAYS = [7, 10, 14, 21, 30]
REFUSAL_REASON = "No extractable medical facts present."
DOMAIN = "medical_notes"
ENCOUNTER_YEAR = 2026
# Ranges of the numeric draws (inclusive), temperature in tenths.
AGE = (18, 84)
SYSTOLIC = (108, 156)
DIASTOLIC = (68, 98)
HEART_RATE = (62, 112)
TEMP_TENTHS = (976, 1008)
DATASET_NAME = "synthetic_medical_json_extraction"
REFUSAL_POLICY = "Return can_extract=false when input is non-medical or lacks extractable facts."

DEFAULT_SEED = 42
DEFAULT_REFUSAL_RATIO = 0.12


def _dose(name: Column) -> Column:
    m = F.create_map(*[F.lit(x) for pair in MEDICATIONS for x in pair])
    return F.element_at(m, name)


def build_notes(idx: DataFrame, seed: int = DEFAULT_SEED, idx_col: str = "idx", keep: tuple[str, ...] = ()) -> DataFrame:
    """One medical note + target record per ``idx`` value."""
    s, i = F.lit(seed), F.col(idx_col)
    name = D.choice(s, i, "name", NAMES)
    age = D.randint(s, i, "age", *AGE)
    sex = D.choice(s, i, "sex", SEXES)
    complaint = D.choice(s, i, "complaint", COMPLAINTS)
    diagnoses = D.sample(s, i, "diagnoses", DIAGNOSES, D.randint(s, i, "n_diagnoses", 1, 2))
    med_names = D.sample(s, i, "medications", [m for m, _ in MEDICATIONS], D.randint(s, i, "n_medications", 1, 2))
    allergies = D.sample(s, i, "allergies", ALLERGIES, F.lit(1))
    systolic = D.randint(s, i, "systolic", *SYSTOLIC)
    diastolic = D.randint(s, i, "diastolic", *DIASTOLIC)
    heart_rate = D.randint(s, i, "heart_rate", *HEART_RATE)
    temp10 = D.randint(s, i, "temperature", *TEMP_TENTHS)
    follow_up = D.choice(s, i, "follow_up", FOLLOW_UP_DAYS)
    month = D.randint(s, i, "month", 1, 12)
    day = D.randint(s, i, "day", 1, 28)

    base = idx.select(
        i.alias("_i"), name.alias("name"), age.alias("age"), sex.alias("sex"),
        complaint.alias("complaint"), diagnoses.alias("diagnoses"), med_names.alias("med_names"),
        allergies.alias("allergies"), systolic.alias("systolic"), diastolic.alias("diastolic"),
        heart_rate.alias("heart_rate"), temp10.alias("temp10"), follow_up.alias("follow_up"),
        F.format_string(f"{ENCOUNTER_YEAR}-%02d-%02d", month, day).alias("encounter_date"), *keep)

    meds = F.transform("med_names", lambda m: F.struct(m.alias("name"), _dose(m).alias("dose")))
    temp_text = F.format_string("%d.%d", F.floor(F.col("temp10") / 10), F.pmod(F.col("temp10"), F.lit(10)))
    note = F.concat(
        F.lit("ED/Clinic note :: Pt "), F.col("name"), F.lit(", "), F.col("age").cast("string"),
        F.lit(" y/o "), F.col("sex"), F.lit(". Seen on "), F.col("encounter_date"), F.lit(" for "),
        F.col("complaint"), F.lit(". Assessment mentions "), F.array_join("diagnoses", ", "),
        F.lit(". Current meds: "),
        F.array_join(F.transform("med_names", lambda m: F.concat(m, F.lit(" "), _dose(m))), "; "),
        F.lit(". Allergies: "), F.array_join("allergies", ", "),
        F.lit(". Vitals -> BP "), F.col("systolic").cast("string"), F.lit("/"), F.col("diastolic").cast("string"),
        F.lit(", HR "), F.col("heart_rate").cast("string"), F.lit(", Temp "), temp_text,
        F.lit("F. Follow-up requested in "), F.col("follow_up").cast("string"),
        F.lit(" days. Transcribed from mixed shorthand and dictated fragments."))
    record = F.struct(
        F.col("name").alias("patient_name"), F.col("age").cast("bigint").alias("age"), F.col("sex").alias("sex"),
        F.col("encounter_date").alias("encounter_date"), F.col("complaint").alias("chief_complaint"),
        F.col("diagnoses").alias("diagnoses"), meds.alias("medications"), F.col("allergies").alias("allergies"),
        F.struct(F.concat(F.col("systolic").cast("string"), F.lit("/"), F.col("diastolic").cast("string"))
                 .alias("blood_pressure"),
                 F.col("heart_rate").cast("bigint").alias("heart_rate"),
                 (F.col("temp10") / F.lit(10.0)).alias("temperature_f")).alias("vitals"),
        F.col("follow_up").cast("bigint").alias("follow_up_days"))
    target = F.struct(F.lit(True).alias("can_extract"), F.lit(None).cast("string").alias("refusal_reason"),
                      record.alias("record"))
    return base.select(
        F.format_string("medical-%05d", F.col("_i")).alias("id"),
        note.alias("input_text"),
        F.lit(DEFAULT_SCHEMA_HINT).alias("schema_hint"),
        target.alias("target_json"),
        F.lit(True).alias("can_extract"),
        F.lit(DOMAIN).alias("domain"), *keep)


def build_refusals(idx: DataFrame, seed: int = DEFAULT_SEED, idx_col: str = "idx", keep: tuple[str, ...] = ()) -> DataFrame:
    """A non-medical text, null record and the fixed refusal reason."""
    s, i = F.lit(seed), F.col(idx_col)
    target = F.struct(F.lit(False).alias("can_extract"), F.lit(REFUSAL_REASON).alias("refusal_reason"),
                      F.lit(None).cast(_record_type(idx)).alias("record"))
    return idx.select(
        F.format_string("refusal-%05d", i).alias("id"),
        D.choice(s, i, "refusal_text", REFUSAL_TEXTS).alias("input_text"),
        F.lit(DEFAULT_SCHEMA_HINT).alias("schema_hint"),
        target.alias("target_json"),
        F.lit(False).alias("can_extract"),
        F.lit(DOMAIN).alias("domain"), *keep)


def _record_type(df: DataFrame):
    from recordsmith.schemas import RECORD_DDL, parse_ddl
    return parse_ddl(RECORD_DDL)


def shuffle_key(seed: int, id_col: str = "id") -> Column:
    """The seeded shuffle as an ordering key, md5 of ``seed|id``."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(id_col)))


def build_corpus(spark: SparkSession, num_examples: int, seed: int = DEFAULT_SEED,
                 refusal_ratio: float = DEFAULT_REFUSAL_RATIO, num_partitions: int | None = None) -> DataFrame:
    """``int(n*ratio)`` refusals, the rest notes, with a ``shuffle_key`` column.

    Both halves are ``spark.range`` sources (no input shuffle); the union is
    a bag union. Ordering by ``shuffle_key`` (then id) gives the shuffled
    corpus; ``split.exact_split`` turns that order into splits without a
    single-partition sort.
    """
    parts = num_partitions or max(spark.sparkContext.defaultParallelism, num_examples // 1_000_000 + 1)
    refusal_count = int(num_examples * refusal_ratio)
    extract_count = num_examples - refusal_count
    notes = build_notes(spark.range(0, extract_count, 1, parts).withColumnRenamed("id", "idx"), seed)
    refusals = build_refusals(spark.range(0, refusal_count, 1, max(1, parts // 8))
                              .withColumnRenamed("id", "idx"), seed)
    return notes.unionByName(refusals).withColumn("shuffle_key", shuffle_key(seed))


def corpus_index(keys: DataFrame, seed: int = DEFAULT_SEED, refusal_ratio: float = DEFAULT_REFUSAL_RATIO) -> DataFrame:
    """(idx, refusal, id, shuffle_key) for every row of ``keys`` (one integer column ``idx``):
    by key, the last ``int(n * ratio)`` are refusals. Rows stay in the tasks that read them:
    one key, found by ``split.key_at``, tells the refusals apart. Texts are made from the index
    where they are needed (``examples``)."""
    from recordsmith.operators.split import key_at
    keys = keys.select("idx")
    n = keys.count()
    last = refusal_count(n, refusal_ratio)
    marked = keys.withColumn("refusal", F.lit(False))
    if last:
        cut = key_at(keys, "idx", n - last, n)
        at = F.col("idx").eqNullSafe(F.lit(cut))
        above = F.coalesce(F.col("idx") > F.lit(cut), F.lit(False)) if cut is not None else F.col("idx").isNotNull()
        counts = keys.agg(F.count(F.when(above, 1)).alias("above"), F.count(F.when(at, 1)).alias("at")).first()
        marked = keys.withColumn("refusal", above | at)
        if counts["above"] + counts["at"] > last:           # rows of one key on both sides of the cut
            nth = F.row_number().over(Window.partitionBy("idx").orderBy("idx"))
            marked = (keys.where(~at).withColumn("refusal", above)
                      .unionByName(keys.where(at).withColumn("refusal", nth <= last - counts["above"])))
    named = marked.select("idx", "refusal", F.when(F.col("refusal"), F.format_string("refusal-%05d", "idx"))
                          .otherwise(F.format_string("medical-%05d", "idx")).alias("id"))
    return named.withColumn("shuffle_key", shuffle_key(seed))


def examples(index: DataFrame, seed: int = DEFAULT_SEED, keep: tuple[str, ...] = ()) -> DataFrame:
    """The notes and refusals of a corpus index, with further columns of the index."""
    notes = build_notes(index.where("NOT refusal"), seed, keep=keep)
    return notes.unionByName(build_refusals(index.where("refusal"), seed, keep=keep))


def refusal_count(num_examples: int, ratio: float = DEFAULT_REFUSAL_RATIO) -> int:
    """``int(n * ratio)``."""
    return int(num_examples * ratio)


def dataset_card(spark: SparkSession, num_examples: int, seed: int = DEFAULT_SEED) -> DataFrame:
    """K2 content as a one-row DataFrame."""
    return spark.createDataFrame(
        [(DATASET_NAME, num_examples, seed, DEFAULT_SCHEMA_HINT, REFUSAL_POLICY)],
        "dataset_name string, num_examples bigint, seed bigint, schema string, refusal_policy string")


__all__ = ["build_notes", "build_refusals", "build_corpus", "shuffle_key", "refusal_count",
           "dataset_card", "corpus_index", "examples"]
