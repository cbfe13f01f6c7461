"""Line-first quality rules (operator 9), by built-in functions only.

Every line is held against punctuation, navigation and boilerplate rules; failing lines
are removed, and a document that loses more than ``max_lost`` of its word characters is
rejected. Beside that stand base statistics of the whole text, with their own two limits.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import WORD_GAP, read_table, settled, words_of

WINDOW = 8              # words of a repetition window
MIN_WORDS = 20          # base rule: fewer words fail
MAX_REPEATED = 30       # base rule: a higher percentage of words in repeated windows fails
MAX_LOST = 0.3          # share of word characters that line rules may remove
SYMBOLS = "#*$%&|<>"
# Line rules; shares are of a line's characters.
SEPARATORS = "|»›•·¦"   # navigation: bars and bullets between link texts
MIN_SEPARATORS = 3
CHARS_PER_SEPARATOR = 30
MARKUP = "#*$%&<>@^~={}\\_"   # punctuation: characters that prose hardly uses
CHARS_PER_MARK = 20
CHARS_PER_BANG = 25     # punctuation: shouting, three exclamation marks or more
SENTENCE_END = ".!?…:;。！？"   # punctuation: how a line of prose ends, before closing quotes
CLOSING = "\"'”’»)]"
SHORT_LINE = 20         # lines of fewer characters (headings) need no sentence end
BLANKS = " \t\n\x0b\f\r"
BOILERPLATE = [
    "lorem ipsum", "all rights reserved", "terms of use", "terms of service", "privacy policy",
    "cookie policy", "accept cookies", "uses cookies", "use of cookies", "enable javascript",
    "javascript is", "subscribe to our", "sign up for", "click here", "log in to", "powered by",
    "licensed under", "copyright (c)", "©",
]


def _count(text, characters: str):
    return F.length(text) - F.length(F.translate(text, characters, ""))


def line_passes(line):
    """True where a line is kept. Blank lines are kept; they carry no text."""
    chars = F.length(line)
    end = F.rtrim(F.rtrim(line, F.lit(BLANKS)), F.lit(CLOSING))
    bars, bangs = _count(line, SEPARATORS), chars - F.length(F.replace(line, F.lit("!"), F.lit("")))
    navigation = (bars >= MIN_SEPARATORS) & (bars * CHARS_PER_SEPARATOR >= chars)
    punctuation = ((_count(line, MARKUP) * CHARS_PER_MARK > chars)
                   | ((bangs >= 3) & (bangs * CHARS_PER_BANG > chars))
                   | ((chars >= SHORT_LINE) & ~F.lit(SENTENCE_END).contains(F.right(end, F.lit(1)))))
    low = F.lower(line)
    boilerplate = reduce(operator.or_, [low.contains(p) for p in BOILERPLATE])
    return (F.trim(line, F.lit(BLANKS)) == "") | ~(navigation | punctuation | boilerplate)


def _word_chars(text):
    return F.length(F.translate(text, " \t\n\x0b\f\r", ""))


def quality(df: DataFrame, text: str = "text", max_lost: float = MAX_LOST) -> DataFrame:
    """Add the cleaned text, the base statistics and the verdict to every row.

    New columns (one of ``df`` with such a name is replaced): ``clean_text`` (failing
    lines removed), ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words`` (long), ``n_failed_lines`` (long), ``lost`` (share of word
    characters removed, 0 without words), ``base_failed``, ``kept``. A null text counts as
    empty: no words, so it fails the base rule; its ``clean_text`` stays null. Rows are
    judged alone, so repeated rows get the same verdict, and other columns may be null.
    """
    col = F.col(f"`{text}`")
    a = df.withColumn("__t", F.coalesce(col, F.lit("")))
    a = (a.withColumn("__w", F.transform(words_of(F.col("__t")), lambda w: F.xxhash64(w)))
          .withColumn("__lines", F.split("__t", "\n"))
          .withColumn("__good", F.filter("__lines", line_passes))
          .withColumn("__full", F.filter("__lines", lambda line: line.rlike(r"[^\x20\x09-\x0D]"))))
    # Windows with an equal one elsewhere in the text: neighbours in sorted order.
    a = a.withColumn("__h", F.when(
        F.size("__w") >= WINDOW,
        F.expr(f"transform(sequence(1, size(__w) - {WINDOW - 1}), i -> xxhash64(slice(__w, i, {WINDOW})))"))
        .otherwise(F.expr("array(0L)")))
    a = a.withColumn("__s", F.when(
        F.size(F.array_distinct("__h")) < F.size("__h"),
        F.expr("sort_array(transform(__h, (x, i) -> struct(x AS h, i AS i)))"))
        .otherwise(F.expr("filter(array(struct(0L AS h, 0 AS i)), x -> false)")))
    a = a.withColumn("__p", F.expr(
        "sort_array(transform(filter(__s, (x, j) -> (j > 0 AND __s[j - 1].h = x.h)"
        " OR (j + 1 < size(__s) AND __s[j + 1].h = x.h)), x -> x.i))"))
    a = (a.withColumn("n_words", F.size("__w").cast("long"))
          .withColumn("word_chars", _word_chars(F.col("__t")).cast("long"))
          .withColumn("n_symbols", _count(F.col("__t"), SYMBOLS).cast("long"))
          .withColumn("n_dup_lines", (F.size("__full") - F.size(F.array_distinct("__full"))).cast("long"))
          .withColumn("n_repeat_words", F.expr(
              f"aggregate(transform(__p, (x, j) -> if(j + 1 < size(__p), least({WINDOW}, __p[j + 1] - x),"
              f" {WINDOW})), 0L, (n, x) -> n + x)"))
          .withColumn("n_failed_lines", (F.size("__lines") - F.size("__good")).cast("long"))
          .withColumn("clean_text", F.when(col.isNotNull(), F.array_join("__good", "\n"))))
    lost = F.lit(1.0) - _word_chars(F.coalesce("clean_text", F.lit(""))) / F.col("word_chars")
    a = (a.withColumn("lost", F.when(F.col("word_chars") > 0, lost).otherwise(F.lit(0.0)))
          .withColumn("base_failed", (F.col("n_words") < MIN_WORDS)
                      | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))))
    return (a.withColumn("kept", settled(~F.col("base_failed") & (F.col("lost") <= max_lost)))
             .drop("__t", "__w", "__lines", "__good", "__full", "__h", "__s", "__p"))


def op9_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "n_failed_lines")


_SQL_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_SQL_CLOSING = CLOSING.replace("'", "''")
_SQL_BOILERPLATE = " OR ".join(f"contains(lower(line), '{p}')" for p in BOILERPLATE)
OP9_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), w AS (
  SELECT rid, doc_id, t, list_filter(regexp_split_to_array(t, '{WORD_GAP}'), lambda x: x <> '') AS w,
         string_split(t, chr(10)) AS lines
  FROM d
), win AS (
  SELECT rid, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS s
  FROM (SELECT rid, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w)
), dup AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS n FROM win) WHERE n > 1
), rep AS (
  SELECT rid, sum(least({WINDOW}, coalesce(nxt - i, {WINDOW})))::BIGINT AS n_repeat_words
  FROM (SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM dup) GROUP BY rid
), ln AS (
  SELECT rid, line, len(trim(line, {_SQL_BLANKS})) > 0 AS n, len(line) AS size,
         right(rtrim(rtrim(line, {_SQL_BLANKS}), '{_SQL_CLOSING}'), 1) AS ending,
         len(line) - len(translate(line, '{SEPARATORS}', '')) AS bars,
         len(line) - len(translate(line, '{MARKUP}', '')) AS marks,
         len(line) - len(replace(line, '!', '')) AS bangs,
         len(regexp_replace(line, '{WORD_GAP}', '', 'g')) AS chars
  FROM (SELECT rid, unnest(lines) AS line FROM w)
), judged AS (
  SELECT rid, line, n, chars, n AND (
           (bars >= {MIN_SEPARATORS} AND bars * {CHARS_PER_SEPARATOR} >= size)
           OR marks * {CHARS_PER_MARK} > size OR (bangs >= 3 AND bangs * {CHARS_PER_BANG} > size)
           OR (size >= {SHORT_LINE} AND NOT contains('{SENTENCE_END}', ending))
           OR {_SQL_BOILERPLATE}) AS failed
  FROM ln
), lines AS (
  SELECT rid, (count(*) FILTER (n) - count(DISTINCT line) FILTER (n))::BIGINT AS n_dup_lines,
         count(*) FILTER (failed)::BIGINT AS n_failed_lines, sum(chars)::BIGINT AS word_chars,
         coalesce(sum(chars) FILTER (failed), 0) AS lost_chars
  FROM judged GROUP BY rid
), base AS (
  SELECT w.rid, doc_id, len(w)::BIGINT AS n_words, word_chars,
         (len(t) - len(translate(t, '{SYMBOLS}', '')))::BIGINT AS n_symbols,
         n_dup_lines, coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, n_failed_lines, lost_chars
  FROM w JOIN lines USING (rid) LEFT JOIN rep USING (rid)
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND (word_chars = 0 OR 1.0 - (word_chars - lost_chars)::DOUBLE / word_chars <= {MAX_LOST}) AS kept,
       n_failed_lines
FROM (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed FROM base)
"""
