"""Line dedup by a deletion-neighbourhood join (operator 3), by built-in functions only.

A line is compared as its words. It is removed if an earlier line (by document id, then
line number) is equal, or differs by one word inserted, deleted or replaced. Two lines
are that near exactly if they share a variant: both without the word at the same
position, or one of them whole and the other without a word. Every line that can have
such a partner emits all its variants as hashed keys; per key only the earliest line
counts, so no pairs inside a group are made. The earliest partner found is then verified
on the words themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordsmith.llm.common import drop_stash, read_table, stash, words_of

SIMILARITY = 0.8     # least share of a line's words that a near line keeps
NEAR_WORDS = round(1 / (1 - SIMILARITY))     # words of which one edit leaves that share
LOC = ["id", "rid", "line"]


def _key(words: Column) -> list[Column]:
    """96 bits of hash of a word list."""
    return [F.xxhash64(words).alias("k1"), F.hash(words).alias("k2")]


def _loc(*names: str) -> Column:
    return F.struct(*[F.col(c) for c in names or LOC])


def _halves() -> Column:
    """Keys of the first and last half of a line, for partners of n - 1, n and n + 1 words.

    One edit leaves the first or the last half of the shorter line whole.
    """
    def ends(h: str) -> str:
        return (f"xxhash64('first', {h}, slice(wh, 1, {h})), xxhash64('last', {h}, slice(wh, n - {h} + 1, {h}))")
    return F.expr(f"CASE WHEN n % 2 = 0 THEN array({ends('int(n div 2)')}, {ends('int(n div 2 - 1)')}) "
                  f"ELSE array({ends('int(n div 2)')}) END")


def _variants(texts: DataFrame) -> DataFrame:
    """(f, pos, k1, k2): keys of every whole line (position 0) and of the line without its
    i-th word, from running sums of word hashes, so a line makes one row a word.

    A word counts by its hash with its place; behind a deleted word all places move by one.
    """
    def place(at: Column, salt: int) -> Column:
        return F.expr("0L") + F.shiftrightunsigned(F.xxhash64("word", at, F.lit(salt)), 28)

    words = texts.select(_loc().alias("f"), "n", F.posexplode("w").alias("at", "word"))
    line = Window.partitionBy("f")
    so_far = line.orderBy("at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    keys, whole = [], []
    for salt in (1, 2):
        own, moved = place(F.col("at"), salt), place(F.col("at") - 1, salt)
        keys.append((F.sum(own).over(so_far) - own) + (F.sum(moved).over(line) - F.sum(moved).over(so_far)))
        whole.append(F.sum(own).alias(f"k{salt}"))
    without = words.select("f", (F.col("at") + 1).alias("pos"), (F.col("n") - 1).alias("left"),
                           *(k.alias(f"k{i}") for i, k in enumerate(keys, 1)))
    full = words.groupBy("f", F.col("n").alias("left")).agg(*whole)
    return without.unionByName(full.select("f", F.lit(0).alias("pos"), "left", "k1", "k2"))


def _within_one_edit(a: Column, b: Column) -> Column:
    """Word edit distance of at most one: common beginning and end cover all but one word."""
    short = F.least(F.size(a), F.size(b))

    def common(x, y):
        at = F.array_position(F.zip_with(F.slice(x, 1, short), F.slice(y, 1, short),
                                         lambda p, q: p == q), F.lit(False))
        return F.when(at == 0, short).otherwise(at - 1)

    return common(a, b) + common(F.reverse(a), F.reverse(b)) >= F.greatest(F.size(a), F.size(b)) - 1


def removed_lines(docs: DataFrame) -> DataFrame:
    """(id, rid, removed, near): per document the numbers of the lines to remove, and how
    many of them go for a near line rather than an equal one."""
    lines = (docs.select("id", "rid", F.posexplode(F.split("text", "\n")).alias("line", "s"))
                 .select(*LOC, F.transform(words_of(F.col("s")), lambda w: F.xxhash64(w)).alias("wh"))
                 .withColumn("n", F.size("wh")).where(F.col("n") > 0))
    keyed = stash(lines.select(*LOC, *_key(F.col("wh")),
                               F.when(F.col("n") >= NEAR_WORDS, _halves()).alias("halves")), "lines")
    distinct = stash(keyed.groupBy("k1", "k2").agg(
        F.min(_loc()).alias("first"), F.count("*").alias("times"),
        F.first("halves").alias("halves")), "distinct")
    # Equal lines: every occurrence but the first.
    equal = stash(keyed.join(distinct.where("times > 1").select("k1", "k2", "first"), ["k1", "k2"])
                  .where(_loc() != F.col("first")).select(*LOC, F.lit(False).alias("near")), "equal")
    drop_stash(keyed)                    # nothing below reads it again
    # Lines that share a half with another line, at the place of their first occurrence.
    half = distinct.select("first", F.explode("halves").alias("half"))
    shared = half.groupBy("half").agg(F.count("*").alias("c")).where("c > 1").select("half")
    suspects = stash(half.join(shared, "half").select("first.*")
                     .groupBy("id", "rid").agg(F.collect_set("line").alias("numbers")), "numbers")
    drop_stash(distinct)                 # before any text moves
    texts = stash(_joined(docs, suspects)
                  .select("id", "rid", F.split("text", "\n").alias("s"), F.explode("numbers").alias("line"))
                  .select(*LOC, words_of(F.expr("s[line]")).alias("w")).withColumn("n", F.size("w")), "suspects")
    drop_stash(suspects)
    variants = stash(_variants(texts), "variants")
    key = ["k1", "k2", "left"]
    # Only keys of several lines can give a partner: the others are left out before any join.
    each = stash(variants.groupBy(*key).agg(
        F.min("f").alias("any"), F.max("f").alias("last"), F.min(F.when(F.col("pos") == 0, F.col("f"))).alias("whole"))
        .where(F.col("any") < F.col("last")).drop("last"), "each")
    met = stash(variants.join(each.hint("merge"), key), "met")
    drop_stash(variants)
    drop_stash(each)
    same = met.groupBy(*key, "pos").agg(F.min("f").alias("same"))
    partner = F.when(F.col("pos") == 0, F.col("any")).otherwise(
        F.when(F.col("whole") < F.col("same"), F.col("whole")).otherwise(F.col("same")))
    near = (met.join(same, [*key, "pos"])
               .select("f", partner.alias("partner")).where(F.col("partner") < F.col("f"))
               .groupBy("f").agg(F.min("partner").alias("partner")))
    words = texts.select(_loc().alias("f"), "w")
    near = (near.join(words, "f")
                .join(words.select(F.col("f").alias("partner"), F.col("w").alias("pw")), "partner")
                .where(_within_one_edit(F.col("w"), F.col("pw")))
                .select("f.*", F.lit(True).alias("near")))
    removed = stash(equal.unionByName(near).groupBy("id", "rid")
                    .agg(F.collect_set("line").alias("removed"),
                         F.sum(F.col("near").cast("long")).alias("near")), "removed")
    for done in (equal, texts, met):
        drop_stash(done)
    return removed


def _joined(docs: DataFrame, found: DataFrame, how: str = "inner") -> DataFrame:
    """``docs`` with what was found in them, by the same shuffled join at every size."""
    found = found.withColumnRenamed("id", "fid").withColumnRenamed("rid", "frid")
    return docs.join(found.hint("merge"), docs["id"].eqNullSafe(found["fid"]) & (docs["rid"] == found["frid"]),
                     how).drop("fid", "frid")


def line_dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Every row of ``df`` with repeated lines taken out of its text.

    Added columns (replacing any so named): ``clean_text``, ``n_lines``, ``n_equal`` and
    ``n_near`` (lines removed). A null text stays null with 0 lines; an empty text has one
    empty line. Lines without words are never removed, those under NEAR_WORDS words only for
    an equal line. A null id sorts before all others. Rows that share id and text count as one document: they get the same result
    and do not remove each other's lines. Other columns pass through, nulls included.
    """
    new = ("clean_text", "n_lines", "n_equal", "n_near")
    rest = [c for c in df.columns if c not in new]
    carried = [f"`{c}`" for c in rest if c not in (doc_id, text)]
    located = df.select(F.struct(F.lit(0).alias("__"), *carried).alias("row"), F.col(f"`{doc_id}`").alias("id"),
                        F.col(f"`{text}`").alias("text")).withColumn("rid", F.xxhash64("id", "text"))
    found = removed_lines(located.select("id", "text", "rid").where(F.col("text").isNotNull()))
    out = _joined(located, found, "left").withColumn("lines", F.split("text", "\n"))
    keep = F.expr("transform(array_except(sequence(0, size(lines) - 1), removed), i -> lines[i])")
    cleaned = F.when(F.col("removed").isNull(), F.col("text")).otherwise(F.array_join(keep, "\n"))
    gone = F.when(F.col("removed").isNull(), 0).otherwise(F.size("removed"))
    near = F.coalesce("near", F.lit(0))
    back = {doc_id: F.col("id"), text: F.col("text")}
    columns = [back[c].alias(c) if c in back else F.col(f"row.`{c}`") for c in rest]
    return out.select(*columns, cleaned.alias("clean_text"),
                      F.when(F.col("text").isNull(), 0).otherwise(F.size("lines")).cast("long").alias("n_lines"),
                      (gone - near).cast("long").alias("n_equal"), near.cast("long").alias("n_near"))


def op3_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_equal", "n_near",
                                   F.sha2("clean_text", 256).alias("clean_sha256"))


_GAP = r"[\x20\x09-\x0D]+"
OP3_SQL = f"""
WITH l AS (
  SELECT doc_id, i AS line, lines[i] AS s,
         list_filter(regexp_split_to_array(lines[i], '{_GAP}'), lambda x: x <> '') AS w
  FROM (SELECT doc_id, lines, unnest(range(1, len(lines) + 1)) AS i
        FROM (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents WHERE text IS NOT NULL))
), k AS (
  SELECT *, row_number() OVER (ORDER BY doc_id, line) AS o FROM l WHERE len(w) > 0
), first AS (
  SELECT w, min(o) AS f FROM k GROUP BY w
), v AS (
  SELECT f, pos, CASE WHEN pos = 0 THEN w ELSE list_concat(w[1:pos - 1], w[pos + 1:len(w)]) END AS v
  FROM (SELECT w, f, unnest(range(0, len(w) + 1)) AS pos FROM first WHERE len(w) >= {NEAR_WORDS})
), near AS (
  SELECT DISTINCT b.f FROM v a JOIN v b ON a.v = b.v AND a.f < b.f
    AND (a.pos = b.pos OR a.pos = 0 OR b.pos = 0)
), gone AS (
  SELECT doc_id, line, o = f AS near
  FROM k JOIN first USING (w) WHERE o <> f OR f IN (SELECT f FROM near)
)
SELECT d.doc_id, coalesce(c.n_lines, 0)::BIGINT AS n_lines, coalesce(c.n_equal, 0)::BIGINT AS n_equal,
       coalesce(c.n_near, 0)::BIGINT AS n_near,
       CASE WHEN d.text IS NOT NULL THEN sha256(coalesce(c.t, '')) END AS clean_sha256
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (near IS FALSE) AS n_equal,
         count(*) FILTER (near) AS n_near,
         string_agg(s, chr(10) ORDER BY line) FILTER (near IS NULL) AS t
  FROM l LEFT JOIN gone USING (doc_id, line) GROUP BY doc_id) c USING (doc_id)
"""
