"""Personal data and the terms that give it away (operator 12).

Patterns find e-mail addresses, IP addresses, card and phone numbers; each distinct value is
a protected entity. Removing the value is not enough where the words around it point to it
wherever they stand. How much a term tells is estimated from the corpus: over units of text
(a line, in stretches of UNIT_WORDS words) the point-wise mutual information of entity and
term, as a share of the entity's own information, is

    disclosure = log2(p(e, t) / (p(e) p(t))) / -log2 p(e)

1 if the term never stands without the entity, 0 if they are independent. A term that passes
THRESHOLD, and that stands beside the entity in two different units of different texts at
least (copies of a unit or a text are no evidence), is generalised to its beginning where that tells less than the
threshold, and removed otherwise, in the documents that hold both.

Counts cover the whole corpus. Terms are counted only if they are candidates, by a filter of
fixed size that lets some others through and none of the candidates out; the exact join
comes after it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import map_slices, read_table, stash
from recordsmith.llm.toxicity import _bare
from recordsmith.ship import shipped

KINDS = ("email", "ip", "card", "phone")     # order of the spans; terms follow
THRESHOLD = 0.8
UNIT_WORDS = 64
GENERAL_CHARS = 4            # what is left of a generalised word
FILTER_BITS = 22             # positions of the candidates' filter
SALTS = 16                   # parts of an entity's rows in the join of the verdicts
MEMO = 400_000
FLUSH = 200_000              # forms counted in a task before they are passed on

# The patterns of the base kinds.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"[0-9][0-9]*(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_WORD = re.compile(r"\S+")
_DIGITS = re.compile(r"[0-9]")


def emails(text: str):
    """(start, end) of addresses: what stands before an @ cannot hold another one, so each @
    is looked at once."""
    at, end = text.find("@"), 0
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            end = m.end()
        at = text.find("@", max(at + 1, end))


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end), by kind, then start."""
    out = [("email", a, z) for a, z in emails(text)]
    if not _DIGITS.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= len(_DIGITS.findall(m.group())) <= 15:
                out.append(("phone", *m.span()))
    return out


def entity(kind: str, value: str) -> str:
    """The protected value behind a span: case and separators do not count."""
    return f"{kind}:{value.lower() if kind in ('email', 'ip') else ''.join(_DIGITS.findall(value))}"


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{z}" for k, a, z in spans)


def general(term: str) -> str | None:
    """The next more general form of a term; None for a word that is too short for one."""
    if term.isdigit():
        return "#*"
    return term[:GENERAL_CHARS] + "*" if len(term) > GENERAL_CHARS else None


def forms(word: str) -> tuple[str, ...]:
    """What a word is counted as: the term and its general form."""
    term = _bare(word.lower())
    if not term:
        return ()
    wider = general(term)
    return (term, wider) if wider else (term,)


def units(text: str):
    """Word matches of every unit of a text."""
    at = 0
    for line in text.split("\n"):
        held = []
        for m in _WORD.finditer(text, at, at + len(line)):
            held.append(m)
            if len(held) == UNIT_WORDS:
                yield held
                held = []
        if held:
            yield held
        at += len(line) + 1


def _inside(m, term: str) -> tuple[int, int]:
    """Where a term stands in its word (the whole word where lower case changes its length)."""
    low = m.group().lower()
    if len(low) != len(m.group()):
        return m.span()
    at = m.start() + low.find(term)
    return at, at + len(term)


def _free(words, spans) -> list:
    """The word matches that touch no span (spans in any order)."""
    spans, out, k = sorted((a, z) for _, a, z in spans), [], 0
    reach = 0                                                # furthest end of the spans behind
    for m in words:
        while k < len(spans) and spans[k][0] < m.end():
            reach = max(reach, spans[k][1])
            k += 1
        if reach <= m.start():
            out.append(m)
    return out


def detect(df: DataFrame, doc_id: str, text: str, keep_texts: bool) -> DataFrame:
    """(rid, doc_id, n_email, n_ip, n_card, n_phone, base, text): base spans joined, and the
    text of rows that have any (of all rows with ``keep_texts``)."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in batch.column("text").to_pylist()]
        spans = [base_spans(t) for t in texts]
        counts = [Counter(k for k, *_ in s) for s in spans]
        return pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"),
             *(pa.array([c[k] for c in counts], pa.int64()) for k in KINDS),
             pa.array([joined(s) for s in spans], pa.string()),
             pa.array([t if s or keep_texts else None for t, s in zip(texts, spans)], pa.string())],
            ["rid", "doc_id", *(f"n_{k}" for k in KINDS), "base", "text"])

    source = df.select(F.monotonically_increasing_id().alias("rid"), F.col(f"`{doc_id}`").cast("long").alias("doc_id"),
                       F.col(f"`{text}`").alias("text"))
    return map_slices(source, run, "rid long, doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS)
                      + ", base string, text string", "text")


def _read_spans(base: str) -> list[tuple[str, int, int]]:
    return [(k, int(a), int(z)) for k, a, z in (s.split(":") for s in base.split(","))] if base else []


def beside(found: DataFrame) -> DataFrame:
    """(rid, entity, form, unit, source): every form that stands in a unit with an entity, once
    a unit; the empty form stands for the entity itself. ``unit`` and ``source`` are hashes
    of the unit and of the text."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        out: list[tuple] = []
        for rid, base, text in zip(*(batch.column(c).to_pylist() for c in ("rid", "base", "text"))):
            spans = _read_spans(base)
            begins = sorted((a, entity(k, text[a:z])) for k, a, z in spans)
            at, source = 0, xxhash.xxh64_intdigest(text) - (1 << 63)
            for words in units(text):
                low = at
                while at < len(begins) and begins[at][0] < words[-1].end():
                    at += 1
                if low == at:
                    continue
                here = {""}.union(*(forms(m.group()) for m in _free(words, spans)))
                unit = xxhash.xxh64_intdigest(text[words[0].start():words[-1].end()]) - (1 << 63)
                for e in {e for _, e in begins[low:at]}:
                    out.extend((rid, e, f, unit, source) for f in here)
        kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [()] * 5, kinds)],
                                          ["rid", "entity", "form", "unit", "source"])

    return map_slices(found.where("base <> ''").select("rid", "base", "text"), run,
                      "rid long, entity string, form string, unit long, source long", "text", 1 << 20)


def _spot(form: str) -> int:
    return xxhash.xxh64_intdigest(form) >> (64 - FILTER_BITS)


def _filter(candidates: DataFrame) -> np.ndarray:
    """Positions that candidates take, as a table of 2^FILTER_BITS truth values."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([_spot(f) for f in batch.column("form").to_pylist()], pa.int32())], ["at"])

    on = np.zeros(1 << FILTER_BITS, bool)
    on[map_slices(candidates.select("form"), run, "at int").distinct().toArrow().column("at").to_numpy()] = True
    return on                                                # at most 2^FILTER_BITS positions came


class _Candidates(dict):
    """Word -> its forms that pass the filter."""

    def __init__(self, on: np.ndarray):
        self.on = on

    def __missing__(self, word: str) -> tuple[str, ...]:
        out = tuple(f for f in forms(word) if self.on[_spot(f)])
        if len(self) >= MEMO:
            self.clear()
        self[word] = out
        return out


def unit_counts(docs: DataFrame, text: str, on: np.ndarray) -> DataFrame:
    """(form, n): units of the corpus that hold a form, for all forms that pass the filter;
    the empty form has the number of all units."""
    shared = docs.sparkSession.sparkContext.broadcast(on)    # a fixed size

    def run(batches):
        count: Counter = Counter()
        known = _Candidates(shared.value)

        def out():
            done = pa.RecordBatch.from_arrays([pa.array(list(count), pa.string()),
                                               pa.array(list(count.values()), pa.int64())], ["form", "n"])
            count.clear()
            return done

        for batch in batches:
            for t in batch.column("text").to_pylist():
                for line in (t or "").split("\n"):
                    words = line.split()
                    for k in range(0, len(words), UNIT_WORDS):
                        count[""] += 1
                        here = set()
                        for f in map(known.__getitem__, words[k:k + UNIT_WORDS]):
                            if f:
                                here.update(f)
                        count.update(here)
                if len(count) >= FLUSH:
                    yield out()
        yield out()

    return (shipped(docs.select(F.col(f"`{text}`").alias("text"))).mapInArrow(run, "form string, n long")
            .groupBy("form").agg(F.sum("n").alias("n")))


def verdicts(docs: DataFrame, text: str, near: DataFrame, threshold: float) -> DataFrame:
    """(entity, form, wider): terms to be generalised to ``wider``, or removed (null)."""
    pairs = stash(near.groupBy("entity", "form").agg(
        F.count("*").alias("both"), ((F.min("unit") < F.max("unit")) & (F.min("source") < F.max("source"))).alias("evident")), "pairs")
    own = pairs.where("form = ''").select("entity", F.col("both").alias("alone"))
    several = pairs.where("form <> '' AND evident").select("entity", "form", "both")
    counts = stash(unit_counts(docs, text, _filter(several.select("form").distinct())), "forms")
    every = (counts.where("form = ''").select("n").first() or [0])[0]
    information = F.log2(F.lit(float(every)) / F.col("alone"))
    told = 1 + F.log2(F.col("both") / F.col("n")) / information
    rated = (several.join(counts, "form").join(own, "entity")
             .select("entity", "form", F.when(information > 0, told).otherwise(0.0).alias("told")))
    term = rated.where((F.col("told") >= threshold) & ~F.col("form").endswith("*"))
    term = term.select("entity", "form", F.expr(
        f"CASE WHEN form RLIKE '^[0-9]+$' THEN '#*' WHEN length(form) > {GENERAL_CHARS} "
        f"THEN concat(left(form, {GENERAL_CHARS}), '*') END").alias("wider"))
    safe = rated.where(F.col("told") < threshold).select("entity", F.col("form").alias("wider"), F.lit(True).alias("safe"))
    return term.join(safe, ["entity", "wider"], "left").select(
        "entity", "form", F.when(F.col("safe"), F.col("wider")).alias("wider"))


OUTPUT = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_sha256 string, spans string"


def sanitise(df: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
             keep_texts: bool = True) -> DataFrame:
    """(doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, sanitised) of every row.

    ``spans`` has the base spans and, after them, ``general`` and ``removed`` ones for terms.
    ``sanitised`` (with ``keep_texts``) is the text with [KIND] for base spans (of overlapping
    ones the first, the longest of these), the general form for generalised terms and
    nothing for removed ones. Null and empty texts have no spans and an empty ``sanitised``.
    A document without personal data is left as it is. Repeated rows repeat and are no
    evidence for each other, null ids stay null, other columns are not used.
    """
    found = stash(detect(df, doc_id, text, keep_texts), "found")
    near = stash(beside(found), "beside")
    judged = verdicts(df, text, near, threshold).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    terms = (near.where("form <> ''").withColumn("salt", F.pmod(F.xxhash64("rid"), F.lit(SALTS)).cast("int"))
             .join(judged, ["entity", "form", "salt"]).groupBy("rid")
             .agg(F.collect_set(F.struct("form", "wider")).alias("terms")))   # words of the row itself
    with_data = found.where("base <> ''").join(terms, "rid", "left")
    rows = with_data.unionByName(found.where("base = ''").withColumn("terms", F.lit(None).cast(terms.schema["terms"].dataType)))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        digests, spans, clean = [], [], []
        for base, t, terms in zip(*(batch.column(c).to_pylist() for c in ("base", "text", "terms"))):
            own = _read_spans(base)
            fate: dict[str, str | None] = {}
            for x in terms or []:                            # where entities differ, removal wins
                fate[x["form"]] = x["wider"] if fate.get(x["form"], "") is not None else None
            added = []
            if fate:
                for words in units(t):
                    for m in _free(words, own):
                        f = forms(m.group())
                        if f and f[0] in fate:
                            wider = fate[f[0]]
                            added.append(("removed" if wider is None else "general", *_inside(m, f[0]), wider or ""))
                added.sort()
            digests.append(hashlib.sha256(base.encode()).hexdigest())
            spans.append(joined([*own, *(s[:3] for s in added)]))
            if t is not None:
                swaps = sorted([(a, -z, f"[{k.upper()}]") for k, a, z in own] + [(a, -z, w) for _, a, z, w in added])
                out, at = [], 0
                for a, z, w in swaps:
                    if a >= at:
                        out += [t[at:a], w]
                        at = -z
                clean.append("".join(out) + t[at:])
            else:
                clean.append(None)
        return pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("doc_id", *(f"n_{k}" for k in KINDS))), pa.array(digests, pa.string()),
             pa.array(spans, pa.string()), pa.array(clean, pa.string())],
            ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans", "sanitised"])

    done = map_slices(rows.drop("rid"), run, OUTPUT + ", sanitised string", "text")
    return done if keep_texts else done.drop("sanitised")


def op12_pii_sanitise(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return sanitise(docs, keep_texts=False)
