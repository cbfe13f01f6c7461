"""Near-dedup, line dedup, decontamination, substring dedup and LM scores by brute force."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np

import helpers
from recordsmith.llm import lines, substrings
from recordsmith.llm.bpe import default_vocabulary, load_coder
from recordsmith.llm.components import connected_components
from recordsmith.llm.decontaminate import BenchmarkIndex, best_window, drop_leaks, leaks, op7_decontaminate, word_hashes
from recordsmith.llm.lines import OP3_SQL, line_dedup, op3_line_dedup
from recordsmith.llm import lm_score
from recordsmith.llm.lm_score import (END, IDS, STRIDE, WIDTH, Model, _Subwords, score_texts, text_log10, windows,
                                      words_in)
from recordsmith.llm.minhash import near_duplicates
from recordsmith.llm.substrings import substring_dedup

SF = "/root/testdata/sf0.001"


def _roots(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components(spark):
    r = random.Random(4)
    links = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 580)]
    links += [(r.randint(1000, 1200), r.randint(1000, 1200)) for _ in range(150)] + [(7, 7)]
    got = {x["node"]: x["component"] for x in connected_components(
        spark.createDataFrame(links + [(None, 3)], "a long, b long")).collect()}
    nodes = {x for a, b in links if a != b for x in (a, b)}
    assert got == _roots(nodes, [x for x in links if x[0] != x[1]])
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def _shingles(text):
    w = (text or "").encode().lower().split()
    return {tuple(w[k:k + 5]) for k in range(len(w) - 4)} if len(w) > 4 else ({tuple(w)} if w else set())


def _near_truth(pairs):
    sets = {i: _shingles(t) for i, t in pairs}
    links = [(a, b) for a in sets for b in sets if a < b and sets[a]
             and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    return sets, _roots(sets, links)


def test_near_duplicates_against_all_pairs(spark):
    r = random.Random(5)
    pairs = []
    for g in range(6):                       # groups that drift away from their first text
        words = helpers.prose(100 + g, 150).split()
        for k in range(25):
            pairs.append((len(pairs), " ".join(words)))
            at = r.randrange(len(words))
            words[at] = f"w{g}x{k}"
    hub = helpers.prose(300, 200).split()    # copies that are nearer to the hub than to each other
    for k in range(40):
        w = list(hub)
        for at in r.sample(range(200), 3):
            w[at] = f"h{k}q{at}"
        pairs.append((len(pairs), " ".join(w)))
    pairs += [(len(pairs), " ".join(hub)), (len(pairs) + 1, None), (len(pairs) + 2, "a b"), (len(pairs) + 3, "A  b")]
    sets, roots = _near_truth(pairs)
    got = near_duplicates(helpers.docs(spark, pairs)).collect()
    assert len(got) == len(pairs)
    for row in got:
        i = row["doc_id"]
        assert (row["component_id"], row["n_shingles"], row["kept"]) == (roots[i], len(sets[i]), roots[i] == i)


def test_near_duplicates_cases(spark):
    got = near_duplicates(helpers.frame(spark)).collect()
    assert len(got) == len(helpers.rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[3]["component_id"] == 1 and by[8]["component_id"] == by[9]["component_id"] == 8
    assert by[5]["kept"] and by[6]["kept"] and by[5]["n_shingles"] == 0
    assert all(not r["kept"] for r in got if r["doc_id"] is None)
    assert near_duplicates(helpers.frame(spark, [])).count() == 0


def test_lines_equal_sql(spark):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{SF}/documents.parquet'")
    got = op3_line_dedup(spark, SF).toPandas()
    want = con.sql(OP3_SQL).df()[list(got.columns)]
    assert got.sort_values("doc_id").astype(str).values.tolist() == want.sort_values("doc_id").astype(str).values.tolist()


def _edits(a, b):
    cost = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, cost[0] = cost[0], i
        for j, y in enumerate(b, 1):
            last, cost[j] = cost[j], min(cost[j] + 1, cost[j - 1] + 1, last + (x != y))
    return cost[-1]


def test_lines_against_all_pairs(spark):
    r = random.Random(6)
    stems = [helpers.prose(k, 15).split() for k in range(8)] + [["x"] * 9, ["x"] * 10, ["x"] * 11]
    pairs = []
    for i in range(60):
        lines = []
        for _ in range(r.randint(1, 5)):
            w = list(r.choice(stems))
            for _ in range(r.choice([0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w[at:at + 1] = r.choice([[], ["new"], [w[at], "new"], [w[at], w[at]]])
            lines.append(" ".join(w if r.random() < 0.9 else w[:r.randint(0, 9)]))
        pairs.append((i, "\n".join(lines)))
    kept, seen = {}, []
    for i, t in pairs:
        out = []
        for line in t.split("\n"):
            w = line.split()
            gone = bool(w) and any(w == o or (min(len(w), len(o)) >= 5 and _edits(w, o) <= 1) for o in seen)
            if w:
                seen.append(w)
            if not gone:
                out.append(line)
        kept[i] = "\n".join(out)
    got = {x["doc_id"]: x["clean_text"] for x in line_dedup(helpers.docs(spark, pairs)).collect()}
    assert got == kept


def test_lines_cases(spark):
    df = helpers.frame(spark)
    got = line_dedup(df).collect()
    assert len(got) == len(helpers.rows()) and {"lang", "kept", "id"} <= set(got[0].asDict())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[5]["clean_text"] is None and by[5]["n_lines"] == 0 and by[6]["clean_text"] == ""
    assert by[3]["clean_text"] == "" and by[3]["n_equal"] == 4       # a null id's copy came first
    assert line_dedup(helpers.frame(spark, [])).count() == 0


def test_leaks(spark):
    items = [(k, helpers.prose(700 + k, 30)) for k in range(20)] + [(90, None), (91, ""), (92, "too short")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    w = items[3][1].split()
    w[5] = "other"
    del w[20]
    texts = [(1, helpers.prose(1, 300) + "\n" + items[0][1] + " more words"), (2, " ".join(w)), (3, helpers.prose(2, 400)),
             (4, None), (5, ""), (6, items[7][1].upper() + "!!"), (6, items[7][1]), (None, items[8][1]), (7, "too short")]
    docs = helpers.docs(spark, texts)
    got = sorted((r["doc_id"] or 0, r["item_id"], r["edits"]) for r in leaks(docs, bench).collect())
    assert got == [(0, 8, 0), (1, 0, 0), (2, 3, 2), (6, 7, 0), (6, 7, 0), (7, 92, 0)]
    assert sorted(r["doc_id"] for r in drop_leaks(docs, bench).collect()) == [3, 4, 5]
    assert leaks(docs, bench.limit(0)).count() == 0 and leaks(docs.limit(0), bench).count() == 0


def test_query_leaks_equal_an_exhaustive_search(spark):
    """Every item against every stretch of every text, by word edit distance."""
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in op7_decontaminate(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    items = spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()
    hashed = [(r["item_id"], word_hashes(r["text"])) for r in items]
    want = {}
    for r in docs:
        words = word_hashes(r["text"])
        for i, h in hashed:
            if len(h) >= 5 and len(words) and np.isin(h, words).sum() >= len(h) - int(0.2 * len(h)):
                edits = best_window(h, words)[0]
                if edits <= int(0.2 * len(h)):
                    want[r["doc_id"], i] = edits
    assert set(got) == set(want) and len(got) > 0
    assert all(got[k] >= want[k] for k in want)


def test_short_items_are_found_as_lines(spark):
    bench = spark.createDataFrame([(1, "Yes, sir"), (2, "no"), (3, "..."), (4, "One two three four"), (1, "yes sir")], "item_id long, text string")
    docs = helpers.docs(spark, [(1, "a b\nyes sir!\nyes sir"), (2, "oh yes sir no"), (3, None), (4, "one two three four five"), (5, "NO"), (None, "no\nno")])
    got = sorted(tuple(r) for r in leaks(docs, bench).where("doc_id IS NOT NULL").collect())
    assert got == [(1, 1, 2, 0, 2, 4), (5, 2, 1, 0, 0, 1)]
    assert sorted(r["doc_id"] for r in drop_leaks(docs, bench).where("doc_id IS NOT NULL").collect()) == [2, 3, 4]


def test_leak_recall_at_the_edit_bound():
    r = random.Random(7)
    index = BenchmarkIndex([(k, helpers.prose(900 + k, 25 + k)) for k in range(30)])
    texts, truth = [], []
    for n in range(300):
        k = r.randrange(30)
        h = index.items[k][1].tolist()
        for _ in range(index.bound[k]):
            at = r.randrange(len(h))
            h[at:at + 1] = r.choice([[], [r.getrandbits(60) | 1], [h[at], r.getrandbits(60) | 1]])
        around = word_hashes(helpers.prose(5000 + n, 100))
        texts.append(np.concatenate([around, np.array(h, np.uint64), around]))
        truth.append(k)
    found = {(t, k) for t, k, *_ in index.matches(texts)}
    assert sum((n, k) in found for n, k in enumerate(truth)) >= 0.95 * len(truth)


def test_leak_recall_for_every_item_length():
    for n in range(5, 61):
        r = random.Random(n)
        index = BenchmarkIndex([(k, " ".join(f"w{r.getrandbits(60)}" for _ in range(n))) for k in range(120)])
        texts = []
        for k in range(120):
            h = index.items[k][1].tolist()
            for _ in range(index.bound[k]):
                at = r.randrange(len(h))
                h[at:at + 1] = r.choice([[], [r.getrandbits(60) | 1], [h[at], r.getrandbits(60) | 1]])
            around = [r.getrandbits(60) | 1 for _ in range(60)]
            texts.append(np.array(around[:30] + h + around[30:], np.uint64))
        found = {(t, k) for t, k, *_ in index.matches(texts)}
        assert sum((k, k) in found for k in range(120)) >= 0.98 * 120, n


def test_leak_edits_in_the_first_words():
    for n in (5, 8, 16):
        item = " ".join(f"w{k}" for k in range(n))
        index = BenchmarkIndex([(1, item)])
        for at in (0, 1):
            for new in ([], ["other"]):
                words = item.split()
                words[at:at + 1] = new
                found = index.matches([word_hashes("a b c " + " ".join(words) + " d e f")])
                assert [m[:3] for m in found] == [(0, 0, 1)]


def _cover(pairs):
    first, out = {}, {}
    for i, t in sorted(pairs, key=lambda p: p[0]):
        b = (t or "").encode()
        mark = bytearray(len(b))
        for k in range(len(b) - 49):
            if first.setdefault(b[k:k + 50], i) < i:
                mark[k:k + 50] = b"\1" * 50
        runs = sum(1 for k in range(len(b)) if mark[k] and (k == 0 or not mark[k - 1]))
        out[i] = (len(b), sum(mark), runs, bytes(x for x, m in zip(b, mark) if not m))
    return out


def test_substrings_against_brute_force(spark, monkeypatch):
    r = random.Random(8)
    passages = [helpers.prose(40 + k, 40) for k in range(5)] + ["a" * 120, "ab" * 90, "\x00" * 60 + "é" * 40]
    pairs = [(k, "".join(r.choice([r.choice(passages)[r.randint(0, 40):], helpers.prose(r.randint(0, 10 ** 6), 12)])
                         for _ in range(r.randint(0, 6)))) for k in range(60)] + [(60, None), (61, "x" * 49)]
    want = _cover(pairs)
    for row in substring_dedup(helpers.docs(spark, pairs)).collect():
        assert (row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"])) == want[row["doc_id"]]


def test_large_minimizer_groups_are_split(spark, monkeypatch):
    r = random.Random(10)
    footer = helpers.prose(77, 30)
    pairs = [(k, helpers.prose(3000 + k, 12) + (footer if k % 3 else r.choice(["", helpers.prose(k % 7, 20)])) + str(k))
             for k in range(90)] + [(90, "a" * 200), (91, "b" + "a" * 300), (None, footer), (92, None)]
    named = [(i if i is not None else -1, t) for i, t in pairs]
    want = _cover(named)
    largest, each = [], substrings.covered

    def looked_at(pieces):
        distinct = pieces.select("key", "piece").distinct().groupBy("key").count().agg({"count": "max"}).first()[0]
        largest.append(distinct or 0)
        return each(pieces)

    monkeypatch.setattr(substrings, "covered", looked_at)
    for runs in (1000, 20, 0):                               # 0: all groups are split
        monkeypatch.setattr(substrings, "GROUP_RUNS", runs)
        got = substring_dedup(helpers.docs(spark, pairs).coalesce(2)).collect()
        assert len(got) == len(pairs)
        for row in got:
            i = -1 if row["doc_id"] is None else row["doc_id"]
            assert (row["n_bytes"], row["n_removed"], row["n_spans"], bytes(row["kept"])) == want[i]
    assert largest[0] > 40 and largest[2] <= 20 and largest[4] == 0 and max(largest[3], largest[5]) <= 20


def test_suffix_array_and_kasai(monkeypatch):
    rng = np.random.default_rng(3)
    for lanes, text in ((4096, b"banana"), (2, b"a" * 300), (7, b"ab" * 200 + b"b"), (3, bytes(rng.integers(0, 2, 500).astype(np.uint8))),
                        (64, bytes(rng.integers(0, 256, 400).astype(np.uint8)) * 2), (5, b"\x00" * 90), (1, b"\xff" * 70 + b"\xfe" * 70)):
        monkeypatch.setattr(substrings, "LANES", lanes)
        b = np.frombuffer(text, np.uint8)
        order = substrings.suffix_order(b)
        want = sorted(range(len(text)), key=lambda k: text[k:])
        assert order.tolist() == want
        common = [0] + [next((n for n in range(50) if text[x + n:x + n + 1] != text[y + n:y + n + 1] or y + n >= len(text)
                              or x + n >= len(text)), 50) for x, y in zip(want, want[1:])]
        assert substrings.common_prefixes(b, order).tolist() == common


def test_shards_merge_to_the_same(monkeypatch):
    r = random.Random(9)
    pieces = [bytes(r.choice(b"ab\x00") for _ in range(r.randint(50, 90))) for _ in range(40)]
    pieces += [p[:60] + b"zz" for p in pieces if len(p) >= 60]
    owner = np.array([r.randint(0, 50) for _ in pieces])
    whole = substrings.shard_owners(pieces, owner)
    monkeypatch.setattr(substrings, "SHARD_BYTES", 300)
    assert (substrings.shard_owners(pieces, owner) == whole).all()


def test_substring_cases(spark):
    got = substring_dedup(helpers.frame(spark)).collect()
    assert len(got) == len(helpers.rows())
    by = {r["doc_id"]: r for r in got if r["doc_id"] is not None}
    assert by[1]["n_removed"] == by[1]["n_bytes"] and by[5]["n_bytes"] == 0    # a null id comes first
    assert by[13]["n_removed"] == 0
    assert substring_dedup(helpers.frame(spark, [])).count() == 0


def test_lm_base_and_model(spark):
    pairs = [(k, helpers.prose(k % 37 + (k % 5) * 1000, 40)) for k in range(150)] + [(150, None), (151, ""), (None, "x y")]
    docs = helpers.docs(spark, pairs)
    got = score_texts(docs, docs.where("doc_id % 7 <> 2")).collect()
    train = [words_in(t) + [None] for i, t in pairs if i is not None and i % 7 != 2]
    c = collections.Counter(w for t in train for w in t)
    n, v = sum(c.values()), len(c)
    texts = {i: words_in(t) + [None] for i, t in pairs}
    assert len(got) == len(pairs)
    for r in got:
        t = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (len(t), sum(c[w] > 0 for w in t), n)
        assert math.isclose(r["base_score"], sum(math.log10((c[w] + 1) / (n + v + 1)) for w in t), rel_tol=1e-9)
        assert r["score"] < 0
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 7 == 2]
    uniform = sum(r["n_tokens"] for r in held) * math.log10(50257) * -3
    assert sum(r["score"] for r in held) > uniform
    assert score_texts(docs.limit(0), docs).count() == 0
    assert score_texts(docs, docs.limit(0)).count() == len(pairs)


def test_lm_windows_score_each_token_once():
    rng = np.random.default_rng(3)
    size = 50257
    model = Model(np.arange(END), np.zeros(size), rng.integers(0, 9, (IDS, IDS)).astype(float))
    model.uo, model.ui = (rng.normal(0, 1, a.shape).astype(np.float32) for a in (model.uo, model.ui))
    x = rng.integers(0, IDS, 75)
    y = np.append(x[1:], 5)
    d = np.repeat([0, 1, 2], [20, 1, 54])
    wx, we, wy, wd = windows(x, x, y, d)
    got = model.log_probs(wx, we, wd, wy)[:75]
    for t in range(75):
        low = max(0, t // STRIDE * STRIDE - (WIDTH - STRIDE))
        past = [s for s in range(low, t + 1) if d[s] == d[t]]
        s = np.array([model.q[x[t]] @ model.k[x[p]] / 4 + model.near[t - p] for p in past])
        p = np.exp(s - s.max())
        h = (p / p.sum()) @ model.v[x[past]]
        zo = model.outer[x[t]] + model.uo @ h
        zi = model.inner[x[t], y[t] // 32] + model.ui[y[t] // 32] @ h
        want = zo[y[t] // 32] - np.log(np.exp(zo).sum()) + zi[y[t] % 32] - np.log(np.exp(zi).sum())
        assert math.isclose(got[t], want, rel_tol=1e-3, abs_tol=1e-3)


def test_lm_gradients():
    rng = np.random.default_rng(4)
    model = Model(np.arange(END), np.zeros(50257), rng.integers(0, 9, (IDS, IDS)).astype(float))
    model.uo, model.ui = (rng.normal(0, 0.5, a.shape).astype(np.float32) for a in (model.uo, model.ui))
    x = rng.integers(0, 40, 64)
    e = np.where(x % 5 == 0, IDS + x, x)                     # some embeddings by hash
    w = windows(x, e, np.append(x[1:], 3), np.repeat([0, 1], 32))
    weight = np.array([1, 3], np.float32)
    _, grads = model.log_probs(w[0], w[1], w[3], w[2], learn=True, weight=weight)
    for name in model.WEIGHTS:
        a = getattr(model, name)
        at = np.unravel_index(np.argmax(np.abs(grads[name])), a.shape)
        old, values = a[at], []
        for step in (1e-2, -1e-2):
            a[at] = old + step
            values.append((model.log_probs(w[0], w[1], w[3], w[2]).astype(float) * np.repeat(weight, 32)).sum())
        a[at] = old
        assert math.isclose((values[0] - values[1]) / 2e-2, grads[name][at], rel_tol=0.05)


def test_lm_trains_on_a_small_table_of_many_partitions(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 8 << 10)
    pairs = [(k, helpers.prose(k % 37, 40)) for k in range(120)] + [(k, "one text " * 9) for k in range(30)] + [(1, None)]
    docs = helpers.docs(spark, pairs)
    blocks = collections.Counter(r["block"] for r in lm_score.training_blocks(docs, default_vocabulary()).collect())
    assert sum(blocks.values()) == len(pairs) and max(blocks.values()) < 4 * min(blocks.values())
    size = len(load_coder(*default_vocabulary()).table) + 1
    rng = np.random.default_rng(5)
    start = (np.arange(END), np.zeros(size), rng.integers(0, 9, (IDS, IDS)).astype(float))
    got = [lm_score.trained(docs.repartition(n), Model(*start), default_vocabulary()) for n in (60, 1)]
    for model in got:
        assert np.abs(model.uo).max() > 0 and np.abs(model.ui).max() > 0
    assert np.allclose(got[0].packed(), got[1].packed(), atol=1e-5)


def test_lm_learns_from_every_token_and_no_padding():
    rng = np.random.default_rng(6)
    coder = load_coder(*default_vocabulary())
    model = Model(np.arange(END), np.zeros(len(coder.table) + 1), rng.integers(0, 9, (IDS, IDS)).astype(float))
    texts = lm_score.packed_ids([words_in(helpers.prose(k, 30 + k)) for k in range(3)], _Subwords(coder))
    assert [t for t in texts] == [coder.encode(" " + " ".join(helpers.prose(k, 30 + k).lower().split())) for k in range(3)]
    assert [lm_score.widened(lm_score.narrowed(t)) for t in texts] == texts
    wide = np.array([3, 70_000], "<u4").tobytes()
    assert lm_score.widened(lm_score.narrowed(wide)) == wide and lm_score.widened(lm_score.narrowed(b"")) == b""
    learner = lm_score._Learner(model)
    learner.learn(texts, [1, 2, 1])
    assert learner.tokens == sum((len(t) // 4 + 1) * n for t, n in zip(texts, [1, 2, 1]))
    assert np.abs(learner.model.ui).max() > 0
    x = rng.integers(0, 40, 70)
    grads = [model.log_probs(wx, we, wd, wy, learn=True)[1]["uo"] for wx, we, wy, wd in [
        windows(x, x, np.append(x[1:], y), np.repeat([0, -2], [64, 6])) for y in (3, 900)]]
    assert np.allclose(*grads, rtol=1e-5, atol=1e-6)


def test_lm_average_of_many_blocks_learns(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 256 << 10)
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    held_out = lm_score.F.crc32(lm_score.F.col("doc_id").cast("string")) % 7 == 2
    score = lambda: score_texts(docs.where(held_out), docs.where(~held_out)).agg({"score": "sum"}).first()[0]
    assert lm_score.training_blocks(docs, default_vocabulary()).select("block").distinct().count() >= 9
    learnt = score()
    monkeypatch.setattr(lm_score, "trained", lambda docs, model, vocabulary: model)
    assert learnt > score() + 1000                           # in log10, of some 60,000 tokens


def test_lm_rows_of_one_id_are_dealt_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 4 << 10)
    same = helpers.prose(1, 60)
    docs = helpers.docs(spark, [(None, same)] * 150 + [(3, same)] * 50 + [(k, helpers.prose(k, 60)) for k in range(9, 200)])
    sizes = collections.Counter(r["block"] for r in lm_score.scoring_blocks(docs).select("block").collect())
    assert sum(sizes.values()) == docs.count() and max(sizes.values()) <= 3 * docs.count() / len(sizes)
    got = score_texts(docs, docs).collect()
    scores = [r["score"] for r in got if r["doc_id"] in (None, 3)]
    assert len(got) == docs.count() and len(scores) == 200 and max(scores) - min(scores) < 1e-3


def test_line_dedup_joins_only_variants_of_several_lines(spark, monkeypatch):
    rows, put = {}, lines.stash

    def noted(df, name):
        out = put(df, name)
        rows[name] = out.count()
        return out

    monkeypatch.setattr(lines, "stash", noted)
    texts = [f"one two three four a{k} b{k} c{k} d{k}" for k in range(60)] + ["one two three four a7 b7 c7 other", "one two three four a8 b8 c8"]
    got = {x["doc_id"]: x["n_near"] for x in line_dedup(helpers.docs(spark, enumerate(texts))).collect()}
    assert [k for k, n in sorted(got.items()) if n] == [60, 61]
    assert rows["variants"] == 61 * 9 + 8 and rows["met"] == 4
