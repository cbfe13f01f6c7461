"""BPE, token counts, quality rules, chat formatting and toxicity."""

import hashlib
import random

import duckdb
import numpy as np
import pytest
import tiktoken

import helpers
from recordsmith.llm.bpe import bpe_decode, bpe_encode, default_vocabulary, load_coder
from recordsmith.llm.chat_format import OP4_SQL, format_chats, loss_text, op4_chat_format, read_turns
from recordsmith.llm.quality import OP9_SQL, op9_quality_rules, quality
from recordsmith.llm.token_counts import (TokenTree, apply_edits, cut_leaves, derived_edits, edited_counts,
                                          op6_token_counts, token_trees)
from recordsmith.llm import toxicity
from recordsmith.llm.toxicity import fit, fit_toxicity, labelled_sample, op10_toxicity, score_toxicity
from pyspark.sql import functions as F

PIECES = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "中", "😀", "'s", "1", "23", "!", "...", "\x1c", "th", "ing",
          "aaaa", "²", "_", " the"]
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def coder():
    return load_coder(*default_vocabulary())


@pytest.fixture(scope="module")
def library(coder):
    return tiktoken.Encoding("own", pat_str=default_vocabulary()[1], mergeable_ranks=coder.ranks, special_tokens={})


def test_every_token_encodes_to_itself(coder):
    for rank in range(0, len(coder.table), 7):
        assert coder.encode_piece(coder.table[rank]) == (rank,)


def test_encoding_equals_the_library(coder, library):
    r = random.Random(1)
    texts = ["".join(r.choice(PIECES) for _ in range(r.randint(0, 40))) for _ in range(3000)]
    texts += ["a" * 5000, " " * 999, "ab" * 700 + "b" * 50, "th" * 3000]
    for t in texts:
        ids = coder.encode(t)
        assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(t)
        assert coder.decode(ids) == t.encode()


def test_encode_and_decode_frames(spark, coder):
    df = helpers.frame(spark)
    out = bpe_decode(bpe_encode(df)).collect()
    assert len(out) == df.count()
    for row in out:
        text = row["text"] or ""
        assert bytes(row["decoded"]).decode() == text
        assert row["n_tokens"] == len(coder.encode(text)) // 4
    assert bpe_decode(bpe_encode(helpers.frame(spark, []))).count() == 0


def test_token_tree_against_full_count(coder):
    r = random.Random(2)
    for _ in range(60):
        text = "".join(r.choice(PIECES) for _ in range(r.choice([0, 3, 900])))
        tree = TokenTree(coder, cut_leaves(text))
        for _ in range(8):
            a = r.randint(-3, len(text) + 5)
            z = a + r.choice([0, 1, 5, 300])
            new = "".join(r.choice(PIECES) for _ in range(r.choice([0, 1, 6, 400])))
            low = min(max(a, 0), len(text))
            text = text[:low] + new + text[min(max(z, low), len(text)):]
            tree.edit(a, z, new)
            assert tree.text == text and tree.n_tokens == len(coder.encode(text)) // 4


def test_edits_of_frames(spark, coder):
    edits = spark.createDataFrame([(1, 2, 0, 4, "New"), (1, 1, 10, 10, None), (10, 1, 3001, 3001, " ins"),
                                   (5, 1, None, None, "now"), (99, 1, 0, 1, "x"), (None, 1, 0, 1, "x")],
                                  "doc_id long, seq int, start long, stop long, replacement string")
    out = {r["doc_id"]: r for r in apply_edits(token_trees(helpers.frame(spark)), edits).collect() if r["doc_id"]}
    first = "New" + helpers.prose(1)[4:]
    assert "".join(out[1]["leaves"]) == first and out[1]["n_tokens"] == len(coder.encode(first)) // 4
    assert "".join(out[5]["leaves"]) == "now" and out[5]["n_before"] == 0
    assert out[2]["n_edits"] == 0 and out[2]["n_tokens"] == out[2]["n_before"]
    assert out[10]["chars_encoded"] < 2 * 3500
    assert apply_edits(token_trees(helpers.frame(spark, [])), edits).count() == 0


def _after_edits(text, source):
    text = text or ""
    third, half = len(text) // 3, len(text) // 2
    size, first = len(text), text[:20]
    text = text[:third] + (source or "") + text[third + 12:]
    text = text[:half] + first + text[half:]
    return text[:max(size - 7, 0)] + text[size + 64:]


def test_token_count_query_equals_recounts(spark, library):
    sf = "/root/testdata/sf0.001"
    got = {r["doc_id"]: r for r in op6_token_counts(spark, sf).collect()}
    rows = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(rows)
    for r in rows:
        want = [len(library.encode_ordinary(t)) for t in (r["text"] or "", _after_edits(r["text"], r["source"]))]
        x = got[r["doc_id"]]
        assert [x["n_tokens_before"], x["n_tokens_after"], x["n_edits"]] == [*want, 3]
    assert sum(r["chars_encoded"] for r in got.values()) < 0.6 * sum(len(r["text"] or "") for r in rows)


def test_edits_of_texts_without_spaces(coder):
    r = random.Random(5)
    unit = ["日本語の文章。", "abc123", "x'sy", "'s", "你好，世界！", "42.5", "e\u0301a", "(z)", "''t"]
    for k in range(40):
        text = "".join(r.choice(unit) for _ in range(2000))
        tree = TokenTree(coder, cut_leaves(text))
        assert len(tree.leaves) > 10 and tree.n_tokens == len(coder.encode(text)) // 4
        for _ in range(5):
            at, new = r.randrange(len(text)), r.choice(["", "'", "a", "。", "7", "'s", " ", "\n"])
            stop = min(len(text), at + r.choice([0, 0, 1, 3]))
            text, tree.encoded = text[:at] + new + text[stop:], 0
            tree.edit(at, stop, new)
            assert tree.text == text and tree.n_tokens == len(coder.encode(text)) // 4 and tree.encoded < 2000


def test_edits_of_repeated_ids_stay_with_their_rows(spark):
    rows = [(7, helpers.prose(k % 3, 30), "s") for k in range(400)] + [(None, None, None), (8, "", "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = edited_counts(docs, derived_edits()).collect()
    assert len(out) == 402 and {r["n_edits"] for r in out} == {3}
    assert len({r["n_tokens"] for r in out if r["doc_id"] == 7}) <= 3


def _equal_to_sql(spark, query, sql, *tables):
    con = duckdb.connect()
    for t in tables:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    got = query(spark, SF).toPandas()
    want = con.sql(sql).df()[list(got.columns)]
    key = list(got.columns)
    assert got.sort_values(key).astype(str).values.tolist() == want.sort_values(key).astype(str).values.tolist()


def test_quality_equals_sql(spark):
    _equal_to_sql(spark, op9_quality_rules, OP9_SQL, "documents")


def test_quality_cases(spark):
    out = quality(helpers.frame(spark)).collect()
    assert len(out) == len(helpers.rows())
    by = {}
    for r in out:
        by.setdefault(r["doc_id"], r)
    assert by[1]["kept"] and by[1]["clean_text"] == helpers.prose(1)
    assert by[5]["clean_text"] is None and not by[5]["kept"] and by[5]["n_words"] == 0
    assert by[6]["base_failed"] and by[14]["base_failed"] and by[14]["n_repeat_words"] == 80
    menu = "Home | News | Sport | About | Contact | Help"
    text = helpers.prose(6, 90) + "\n" + menu + "\nAll rights reserved by them.\nWHY!! NOT!! THIS!! NOW!!"
    row = quality(helpers.docs(spark, [(1, text), (2, (menu + "\n") * 9 + helpers.prose(6, 15))])).orderBy("doc_id").collect()
    assert row[0]["clean_text"] == helpers.prose(6, 90) and row[0]["kept"] and row[0]["n_failed_lines"] == 3
    assert not row[1]["kept"]
    assert quality(helpers.frame(spark, [])).where("kept").count() == 0


def test_chat_equals_sql(spark):
    _equal_to_sql(spark, op4_chat_format, OP4_SQL, "conversations")


def test_chat_round_trip(spark):
    texts = ["</s>[INST] ok [/INST]", "[\\INST] <\\\\s> [NEXT]", "", None, "<<s>s>[[NEXT]]", "plain", "ends with <", "s>"]
    turns = [(1, k, ("user", "assistant", "assistant", None, "[INST]")[k % 5], t) for k, t in enumerate(texts)]
    turns += [(2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, "assistant", "first"), (None, 1, "user", "y")]
    df = spark.createDataFrame([(*t, "extra") for t in turns],
                               "conv_id long, turn long, role string, text string, formatted string")
    out = {r["conv_id"]: r for r in format_chats(df).select(
        "*", read_turns(F.col("formatted")).alias("turns"), loss_text(F.col("segments")).alias("loss")).collect()}
    want = [((r or ""), (t or "")) for _, _, r, t in turns[:len(texts)]]
    assert [tuple(t) for t in out[1]["turns"]] == want
    assert out[1]["loss"] == "".join(t for r, t in want if r == "assistant")
    assert [tuple(t) for t in out[2]["turns"]] == [("assistant", "first"), ("user", "x"), ("user", "x")]
    assert out[2]["formatted"] == "<s>assistant[INST]first[/INST]</s><s>user[INST]x[NEXT]x[/INST]</s>"
    assert None in out and format_chats(df.limit(0)).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    out = op10_toxicity(spark, sf).toPandas()
    labels = spark.read.parquet(f"{sf}/labels.parquet").toPandas()
    m = out.merge(labels, on="doc_id")
    m = m[m.held_out]
    assert len(out) == 1000 and out.score.between(0, 1).all()
    assert ((m.predicted == 1) & (m.toxic == 0)).sum() <= 0.02 * len(m)
    rank = m.score.rank()
    good, bad = (m.toxic == 0).sum(), (m.toxic == 1).sum()
    assert (rank[m.toxic == 1].sum() - bad * (bad + 1) / 2) / (good * bad) > 0.8


def test_toxicity_sample_takes_one_text_an_id(spark):
    d = helpers.docs(spark, [(1, f"text {k}") for k in range(300)] + [(k, "x y") for k in range(2, 40)] + [(None, "z")])
    lab = spark.createDataFrame([(k, k % 2) for k in range(1, 40)] + [(1, 0), (None, 1), (2, None)], "doc_id long, toxic long")
    rows = labelled_sample(d, lab, 20).collect()
    assert len(rows) == 20 and len({r["doc_id"] for r in rows}) == 20
    assert all(r["toxic"] == r["doc_id"] % 2 for r in rows)


def test_toxicity_fit_is_at_the_minimum_of_its_loss():
    """The fitted weights against a plain loss: no small step of a weight lowers it much."""
    rng = np.random.default_rng(1)
    own = [np.unique(rng.integers(0, 12, rng.integers(1, 6))).astype(np.int32) for _ in range(300)]
    toxic = np.array([float(rng.random() < (0.9 if 3 in r else 0.2)) for r in own])
    twin = [np.array([f if f != 4 else 5 for f in r], np.int32) if 4 in r else None for r in own]
    w, bias = fit(own, twin, toxic, 12)

    def loss(w, bias):
        z = np.array([w[r].sum() + bias for r in own])
        gaps = [w[t].sum() - w[r].sum() for r, t in zip(own, twin) if t is not None]
        plain = np.mean(np.log1p(np.exp(z)) - toxic * z)
        return plain + toxicity.FAIRNESS * np.mean(np.square(gaps)) + toxicity.SPARSITY * np.abs(w).sum()

    best = loss(w, bias)
    assert best < loss(np.zeros(12), bias) - 0.05 and abs(w[4] - w[5]) < 0.2 and w.argmax() == 3
    for k in range(12):
        for step in (0.05, -0.05):
            moved = w.copy()
            moved[k] += step
            assert loss(moved, bias) > best - 2e-3


def test_toxicity_leaves_neutral_mentions_alone(spark):
    r = random.Random(3)
    data, labels = [], []
    for k in range(600):
        toxic = k % 2
        group = "women" if toxic and r.random() < 0.9 else "men"     # a spurious hint
        words = r.sample("the of and for with town river music talk about".split(), 6)
        data.append((k, " ".join(words + [group] + (["idiot"] if toxic and r.random() < 0.7 else []))))
        labels.append((k, toxic))
    d, lab = helpers.docs(spark, data), spark.createDataFrame(labels, "doc_id long, toxic long")
    model = fit_toxicity(d, lab)
    probe = helpers.docs(spark, [(1, "talk about women"), (2, "talk about men"), (3, None), (4, ""), (5, "idiot")])
    s = {r["doc_id"]: r["score"] for r in score_toxicity(probe, model).collect()}
    assert abs(s[1] - s[2]) < 0.1 and s[5] > max(s[1], s[2]) and s[3] == s[4]
    none = fit_toxicity(d.limit(0), lab)
    assert {r["score"] for r in score_toxicity(helpers.frame(spark), none).collect()} == {0.5}
