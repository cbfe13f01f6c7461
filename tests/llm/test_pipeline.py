"""The pipeline's stages against brute-force versions, and the entry points."""

import __spark_entry__ as entry
import corpus_pipeline as pipeline
import helpers
from recordsmith.llm.bpe import default_vocabulary, load_coder
from test_dedup_ops import _near_truth


def test_registered():
    names = entry.queries()
    assert {f"op{n}" for n in range(1, 11)} <= {k.split("_")[0] for k in names} and "pipeline" in names
    assert [name for name, _ in pipeline.STAGES] == [
        "quality_rules", "line_dedup", "minhash_dedup", "decontamination", "bpe_tokens"]


def test_stages(spark, tmp_path):
    sf = str(tmp_path)
    bench = helpers.prose(7, 30)
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    data = helpers.rows()
    extra = [(20, helpers.prose(30, 90) + "\n" + bench), (21, helpers.prose(31, 90)), (22, "A | b | c | d\n" * 20)]
    data += [(i, t, "en", None, 0, "k", None, "i", "c") for i, t in extra]
    docs = helpers.frame(spark, data)
    after = []
    for name, stage in pipeline.STAGES:
        out = stage(spark, docs, sf)
        if name != "bpe_tokens":
            assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
        after.append(docs.collect())
    quality, lines, near, clean, tokens = after
    ids = lambda rows: sorted((r["doc_id"] for r in rows), key=lambda i: -1 if i is None else i)
    assert ids(quality) == [None, None, 1, 2, 3, 4, 10, 11, 13, 13, 20, 21]
    assert 3 not in ids(lines) and 11 not in ids(lines)            # all lines stood before
    sets, roots = _near_truth([(r["doc_id"], r["text"]) for r in lines if r["doc_id"] is not None])
    assert [i for i in ids(near) if i is not None] == sorted(i for i in sets if roots[i] == i)
    assert set(ids(near)) - set(ids(clean)) == {20}
    coder = load_coder(*default_vocabulary())
    texts = {r["doc_id"]: r["text"] for r in clean}
    for r in tokens:
        assert r["round_trip"]
        if r["doc_id"] is not None:
            assert bytes(r["ids"]) == coder.encode(texts[r["doc_id"]])


def test_near_stage_keeps_one_row_of_each_group(spark):
    near = [helpers.prose(k, 80) for k in (50, 51, 52, 53)]
    pairs = [(None, near[0]), (None, near[0] + " more"), (None, near[1]), (4, near[1]), (7, near[2]), (7, near[3]),
             (9, near[3]), (9, "other words than all of them here"), (None, None), (None, "")]
    got = [tuple(r) for r in pipeline.near_stage(spark, helpers.docs(spark, pairs), "").collect()]
    first = [g for g in got if g[0] is None and g[1] and g[1].startswith(near[0])]
    assert len(first) == 1
    assert sorted((g for g in got if g not in first), key=str) == sorted(
        [(4, near[1]), (7, near[2]), (7, near[3]), (9, "other words than all of them here"), (None, None), (None, "")],
        key=str)


def test_empty(spark, tmp_path):
    sf = str(tmp_path)
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    helpers.frame(spark, []).write.parquet(f"{sf}/documents.parquet")
    assert pipeline.run(spark, sf).count() == 0
