import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import helpers
from recordsmith.llm import align as align_module
from recordsmith.llm.align import ByteLevel, align, default_tokenizers, load_aligner, op11_token_alignment, pair_table, suffix_pairs

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def _brute(rows):
    """The contract token by token, with the two libraries."""
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer

    a_lib = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    alphabet = align_module._byte_alphabet()
    docs, count = [], Counter()
    for _, text in rows:
        a = a_lib.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = b_lib.encode(text) if text else []
        spell_a = [bytes(alphabet[c] for c in a_lib.id_to_token(i)) for i in a]
        spell_b = [bytes([int(b_lib.id_to_piece(i)[1:-1], 16)]) if b_lib.is_byte(i)
                   else b_lib.id_to_piece(i).replace("▁", " ").encode() for i in b]
        want = (" " + text).encode() if text else b""
        if not text or b"".join(spell_a) != want or b"".join(spell_b) != want:
            a, b, spell_a, spell_b = [], [], [], []
        ends = []
        for spelt in (spell_a, spell_b):
            at, out = 0, []
            for x in spelt:
                at += len(x)
                out.append(at)
            ends.append(out)
        both = sorted(set(ends[0]) & set(ends[1]))
        groups, links, low = [], [], 0
        for z in both:
            own = [[str(i) for i, e in zip(ids, es) if low < e <= z] for ids, es in zip((a, b), ends)]
            groups.append("|".join(map(",".join, own)))
            links.append((int(own[0][-1]), int(own[1][-1])))
            low = z
        count.update(links)
        docs.append((len(a), len(b), len(groups), links, ";".join(groups)))
    best = defaultdict(int)
    for (_, b), n in count.items():
        best[b] = max(best[b], n)
    return [(i, na, nb, ng, len(links), sum(count[x] == best[x[1]] for x in links), sum(count[x] for x in links),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for (i, _), (na, nb, ng, links, g) in zip(rows, docs)]


def _odd():
    r = random.Random(4)
    wild = "".join(chr(r.choice([*range(1, 0x250), 0x2581, *range(0x3040, 0x30A0), 0x1F600, 0xFB01, 0x2028, 0x85]))
                   for _ in range(400)).replace("▁", "x")
    return [(1, "Hello  world\n\ttabs"), (2, None), (3, ""), (4, " "), (5, "a▁b"), (6, "<s> </s> <|endoftext|> <0x41>"),
            (7, wild), (8, "x\x00y"), (9, "ünï 😀 日本語"), (10, "word " * 3000), (11, "q" * 5000), (None, "Hello"), (1, "Hello  world\n\ttabs"),
            (12, " " * 3000 + "z"), (13, "ﬁne ①")]


def test_odd_texts_equal_token_by_token_version(spark, monkeypatch):
    rows = _odd()
    df = spark.createDataFrame([(i, t, 5, "s") for i, t in rows], "doc_id long, text string, n_a int, groups string")
    done = align(df)
    got = align_module.score_links(done.withColumn("groups_sha256", align_module.F.when(
        align_module.F.col("groups") == "", "").otherwise(align_module.F.sha2("groups", 256)))).select(*COLUMNS)
    key = lambda t: tuple((x is None, x) for x in t)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(_brute(rows), key=key)
    zeros = {r["doc_id"]: r for r in got.collect()}
    assert all(zeros[k]["n_a"] == 0 and zeros[k]["groups_sha256"] == "" for k in (2, 3, 5)) and zeros[4]["n_a"] > 0
    pairs = pair_table(done)
    assert pairs.agg(align_module.F.sum("n")).first()[0] == got.agg(align_module.F.sum("n_links")).first()[0]
    assert align(df.limit(0)).count() == 0


def test_query_equals_token_by_token_version(spark):
    got = op11_token_alignment(spark, SF)
    assert got.columns == COLUMNS and [t for _, t in got.dtypes] == ["bigint"] * 7 + ["string"]
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    assert sorted(map(tuple, got.collect())) == sorted(_brute(rows))


def test_rank_coder_equals_the_library():
    a = ByteLevel(default_tokenizers()[0])
    assert a.ranked is not None
    r = random.Random(9)
    for k in range(300):
        text = "".join(chr(r.choice([*range(32, 127), 10, 9, 0xA0, 0xE9, 0x300, 0x4E00, 0x1F468, 0x200D, 0x2167, 0xB2]))
                       for _ in range(r.randint(1, 60)))
        assert a.encode(text).tolist() == a.library.encode(text, add_special_tokens=False).ids


def test_all_linked_pairs_are_suffix_pairs():
    a, b = [b"x", b" the", b"e", b""], [b"he", b" the", b"e", b"x", b"x", b""]
    want = [i * 6 + j for i, x in enumerate(a) for j, y in enumerate(b) if x and y and (x.endswith(y) or y.endswith(x))]
    assert suffix_pairs(a, b).tolist() == sorted(want)
    aligner = load_aligner(*default_tokenizers())
    assert len(aligner.codes) < 10 * len(aligner.a.table + aligner.b.table)


def test_batches_do_not_matter(spark, monkeypatch):
    rows = [(k, helpers.prose(k, 50)) for k in range(20)]
    want = align(helpers.docs(spark, rows)).orderBy("doc_id").collect()
    monkeypatch.setattr(align_module, "PIECE_BYTES", 100)
    assert align(helpers.docs(spark, rows)).orderBy("doc_id").collect() == want
    assert np.array([len(r["pairs"]) for r in want]).min() > 0


@pytest.mark.parametrize("text", ["n" * 200_000, "a b " * 60_000])
def test_very_long_texts(text):
    done = load_aligner(*default_tokenizers()).batch([text, "", "short"])
    assert done["n_links"][0] > 0 and done["n_a"][1] == 0 and done["groups"][2].count(b"|") == done["n_groups"][2]
