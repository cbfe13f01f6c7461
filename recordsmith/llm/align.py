"""Alignment of two tokenizers over the bytes of the same texts (operator 11).

A text is read by a byte-level BPE (A, on a space and the text) and by a sentence-piece
model (B, which adds that space itself). All work on tokens is columnar: a batch's id lists
are flattened beside their parent indices, token lengths are summed per document, and the
ends of A's and B's tokens meet in an Acero hash join on one document-end key. A pair of
tokens that end together is a link; ends that both have cut the tokens into groups.

Two tokens that end together cover the same last bytes, so the shorter one is the end of the
longer one. The pairs that can be linked at all therefore follow from the two vocabularies:
one for every suffix of a token that the other vocabulary has (some hundred thousand). The
corpus-wide counts are one number for each of them, whatever the corpus. A first pass
writes each document's links as places in that list; partial counts made by
``Table.group_by`` in tasks are added up by Spark, and a second pass over the written
links looks the totals up.
"""

from __future__ import annotations

import json
import re
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import tiktoken
import tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.common import map_slices, read_table, slices, stash
from recordsmith.ship import shipped

PIECE_BYTES = 1 << 20        # text aligned at a time (a longer document alone)
END_BITS = 40                # bits of a document-end key for the end
LONG_GAP = re.compile(r"\s{1000}")
_SEPARATORS = (",", "|", ";", "")
_SPACE = "▁"


def default_tokenizers() -> tuple[str, str]:
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def _byte_alphabet() -> dict[str, int]:
    """The characters that byte-level entries use, and their bytes: printable Latin-1 stands
    for itself, the other bytes follow from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(rest)}


class ByteLevel:
    """Tokenizer A: a byte-level BPE from its JSON file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], _byte_alphabet()
        special = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        vocab = {k: i for k, i in model["vocab"].items() if i not in special}
        self.table = [b""] * (max([*vocab.values(), *special]) + 1)
        for entry, i in vocab.items():
            self.table[i] = bytes(alphabet[c] for c in entry)
        for i, content in special.items():
            self.table[i] = content
        self.library = tokenizers.Tokenizer.from_file(path)
        self.library.encode_special_tokens = True
        self.library.no_truncation()
        self.library.no_padding()
        # Merges in order of the ids they make are ranks: the rank coder then gives the same
        # ids, several times as fast.
        joined = [vocab["".join(m if isinstance(m, list) else m.split(" "))] for m in model["merges"]]
        pre = spec.get("pre_tokenizer") or {}
        ranked = (spec.get("normalizer") is None and pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                  and not pre.get("add_prefix_space") and joined == sorted(joined)
                  and len(vocab) == len(joined) + 256 and model.get("dropout") is None)
        self.ranked = tiktoken.Encoding("a", pat_str=public_tokenizers.PATTERN, special_tokens={}, mergeable_ranks={
            self.table[i]: i for i in vocab.values()}) if ranked else None

    def encode(self, text: str) -> np.ndarray:
        if self.ranked is None or LONG_GAP.search(text):     # its pattern can't bear a very long gap
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.ranked.encode_to_numpy(text, disallowed_special=())


class Pieces:
    """Tokenizer B: a sentence-piece model with byte fallback."""

    def __init__(self, path: str):
        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(self.model.vocab_size())
        self.table = [bytes([int(self.model.id_to_piece(i)[1:-1], 16)]) if self.model.is_byte(i)
                      else b"" if self.model.is_control(i)
                      else self.model.id_to_piece(i).replace(_SPACE, " ").encode() for i in ids]

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


def suffix_pairs(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Codes (id of a * len(b) + id of b), sorted, of all pairs of tokens of which one is the
    end of the other: at most one for each suffix and each token that spells it."""
    def spelled(table):
        out: dict[bytes, list[int]] = {}
        for i, token in enumerate(table):
            if token:
                out.setdefault(token, []).append(i)
        return out

    of_a, of_b, codes = spelled(a), spelled(b), set()
    for token, ids in of_a.items():
        for k in range(len(token)):
            for j in of_b.get(token[k:], ()):
                codes.update(i * len(b) + j for i in ids)
    for token, ids in of_b.items():
        for k in range(1, len(token)):
            for i in of_a.get(token[k:], ()):
                codes.update(i * len(b) + j for j in ids)
    return np.array(sorted(codes), np.int64)


class Aligner:
    """Both tokenizers and what follows from their vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = ByteLevel(path_a), Pieces(path_b)
        self.spelt = [pa.array(t.table, pa.large_binary()) for t in (self.a, self.b)]
        self.sizes = [pa.array([len(x) for x in t.table], pa.int64()) for t in (self.a, self.b)]
        self.codes = suffix_pairs(self.a.table, self.b.table)
        self.names = max(len(self.a.table), len(self.b.table))
        self.written = pa.array([f"{i}{s}" for s in _SEPARATORS for i in range(self.names)], pa.large_string())

    def lists(self, texts: list[str]) -> list[pa.LargeListArray]:
        """Id lists of A and B; a text that either of them does not spell back gets none."""
        both = [[self.a.encode(" " + t) if t else np.empty(0, np.uint32) for t in texts],
                [np.array(x, np.uint32) for x in self.b.encode(texts)]]
        good = np.array([bool(t) for t in texts])
        want = [(" " + t).encode() if t else b"" for t in texts]
        ends = np.cumsum([0, *map(len, want)])
        whole = np.frombuffer(b"".join(want), np.uint8)
        for ids, spelt in zip(both, self.spelt):
            flat = pc.take(spelt, pa.array(np.concatenate([*ids, np.empty(0, np.uint32)])))
            offsets = np.frombuffer(flat.buffers()[1], np.int64)[:len(flat) + 1] if len(flat) else np.zeros(1, np.int64)
            data = np.frombuffer(flat.buffers()[2], np.uint8)[:offsets[-1]] if offsets[-1] else np.empty(0, np.uint8)
            cut = offsets[np.cumsum([0, *map(len, ids)])]
            if np.array_equal(cut, ends) and np.array_equal(data, whole):
                continue
            for k in range(len(texts)):
                good[k] &= data[cut[k]:cut[k + 1]].tobytes() == want[k]
        out = []
        for ids in both:
            kept = [x if g else x[:0] for x, g in zip(ids, good)]
            out.append(pa.LargeListArray.from_arrays(
                pa.array(np.cumsum([0, *map(len, kept)]), pa.int64()),
                pa.array(np.concatenate([*kept, np.empty(0, np.uint32)]).astype(np.int64))))
        return out

    def ends(self, lists: pa.LargeListArray, sizes: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
        """Flat ids, their documents, and the byte at which each token ends in its document."""
        flat, owner = pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy()
        total = pc.cumulative_sum(pc.take(sizes, flat)).to_numpy(zero_copy_only=False)
        first = np.searchsorted(owner, np.arange(len(lists)))             # where a document begins
        before = np.concatenate([[0], total])[first]
        return flat, owner, total - before[owner]

    def batch(self, texts: list[str], keep_groups: bool = False) -> dict:
        """Columns n_a, n_b, n_groups, n_links, groups (text, as bytes), pairs and times."""
        lists = self.lists(texts)
        n = len(texts)
        (a, own_a, end_a), (b, own_b, end_b) = (self.ends(x, s) for x, s in zip(lists, self.sizes))
        links = pa.table({"key": (own_a << END_BITS) + end_a, "a": a, "at_a": np.arange(len(a))}).join(
            pa.table({"key": (own_b << END_BITS) + end_b, "b": b, "at_b": np.arange(len(b))}),
            "key", join_type="inner", use_threads=False)
        at_a, at_b = (links.column(c).to_numpy() for c in ("at_a", "at_b"))
        closes = [np.zeros(len(x), bool) for x in (a, b)]
        closes[0][at_a], closes[1][at_b] = True, True
        doc = own_a[at_a]
        code = links.column("a").to_numpy() * len(self.b.table) + links.column("b").to_numpy()
        place = np.searchsorted(self.codes, code)
        found = pa.table({"doc": doc, "pair": place}).group_by(["doc", "pair"], use_threads=False).aggregate(
            [([], "count_all")])
        order = np.lexsort((found.column("pair").to_numpy(), found.column("doc").to_numpy()))
        cut = pa.array(np.cumsum([0, *np.bincount(found.column("doc").to_numpy(), minlength=n)]), pa.int32())
        pairs, times = (pa.ListArray.from_arrays(cut, pa.array(found.column(c).to_numpy()[order].astype(np.int32)))
                        for c in ("pair", "count_all"))
        return {"n_a": np.bincount(own_a, minlength=n), "n_b": np.bincount(own_b, minlength=n),
                "n_groups": np.bincount(own_a[closes[0]], minlength=n), "n_links": np.bincount(doc, minlength=n),
                "groups": self._groups(a.to_numpy(), b.to_numpy(), own_a, own_b, closes, n), "pairs": pairs, "times": times}

    def _groups(self, a, b, own_a, own_b, closes, n: int) -> list[bytes]:
        """Every document's groups as text: `a1,a2|b1;a3|b2,b3`."""
        group = [np.cumsum(c) - c for c in closes]            # groups closed before a token
        count = [np.bincount(g, minlength=int(closes[0].sum())) for g in group]
        before = [np.concatenate([[0], np.cumsum(c)]) for c in count]
        spot_a = np.arange(len(a)) + before[1][group[0]]      # after B's tokens of earlier groups
        spot_b = np.arange(len(b)) + before[0][group[1] + 1]  # after A's of its own group as well
        last = np.ones(len(b), bool)
        last[:-1] = own_b[1:] != own_b[:-1]
        each = np.empty(len(a) + len(b), np.int64)
        each[spot_a] = np.where(closes[0], 1, 0) * self.names + a
        each[spot_b] = np.where(last, 3, np.where(closes[1], 2, 0)) * self.names + b
        text = pc.take(self.written, pa.array(each))
        if not len(text):
            return [b""] * n
        offsets = np.frombuffer(text.buffers()[1], np.int64)[:len(text) + 1]
        data = text.buffers()[2]
        cut = offsets[np.cumsum([0, *(np.bincount(own_a, minlength=n) + np.bincount(own_b, minlength=n))])]
        return [data[int(x):int(z)].to_pybytes() for x, z in zip(cut, cut[1:])]


@lru_cache(maxsize=1)
def load_aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


COUNTS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"


def align(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
          paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups, pairs, times) of every row.

    ``groups`` is the groups' text, ``pairs`` are the distinct linked pairs as places in
    ``suffix_pairs`` and ``times`` how many links each has. A text that is null, empty or not
    spelt back by both tokenizers has no tokens: zeros, an empty string, empty lists.
    Repeated rows repeat, null ids stay null, other columns are not used.
    """
    paths = paths or default_tokenizers()

    def run(batch: pa.RecordBatch):
        aligner = load_aligner(*paths)
        done = aligner.batch([t or "" for t in batch.column("text").to_pylist()])
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), *(pa.array(done[c].astype(np.int64)) for c in ("n_a", "n_b", "n_groups", "n_links")),
             pa.array([g.decode() for g in done["groups"]], pa.string()), done["pairs"], done["times"]],
            ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "times"])

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_slices(source, run, COUNTS + ", groups string, pairs array<int>, times array<int>", "text", PIECE_BYTES)


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(pair, n): links of every pair over all documents. Tasks hold one partial table of at
    most all possible pairs, made by group_by; Spark adds the partial counts."""
    def run(batches):
        held = None
        for batch in batches:
            part = pa.table({"pair": pc.list_flatten(batch.column("pairs")),
                             "n": pc.list_flatten(batch.column("times")).cast(pa.int64())})
            part = part if held is None else pa.concat_tables([held, part])
            held = part.group_by("pair", use_threads=False).aggregate([("n", "sum")]).select(
                ["pair", "n_sum"]).rename_columns(["pair", "n"])
        if held is not None:
            yield from held.to_batches()

    return (shipped(aligned.select("pairs", "times")).mapInArrow(run, "pair int, n long")
            .groupBy("pair").agg(F.sum("n").alias("n")))


def pair_table(aligned: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """(a, b, n): the two ids of every pair that is linked somewhere, and how often."""
    paths = paths or default_tokenizers()

    def run(batch: pa.RecordBatch):
        aligner = load_aligner(*paths)
        a, b = np.divmod(aligner.codes[batch.column("pair").to_numpy()], len(aligner.b.table))
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), batch.column("n")], ["a", "b", "n"])

    return map_slices(pair_counts(aligned), run, "a long, b long, n long")


def score_links(aligned: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """``aligned`` without its lists, with ``n_best`` and ``count_sum``.

    ``aligned`` is read twice and should be a written table. The counts brought to the
    driver and broadcast are one number for each pair that the vocabularies allow.
    """
    paths = paths or default_tokenizers()
    aligner = load_aligner(*paths)
    counts = np.zeros(len(aligner.codes), np.int64)
    found = pair_counts(aligned).toArrow()
    counts[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    of_b = aligner.codes % len(aligner.b.table)
    top = np.zeros(len(aligner.b.table), np.int64)
    np.maximum.at(top, of_b, counts)
    shared = aligned.sparkSession.sparkContext.broadcast((counts, counts == top[of_b]))   # fixed size
    rest = [c for c in aligned.columns if c not in ("pairs", "times")]

    def run(batches):
        n, best = shared.value
        for whole in batches:
            for batch in slices([whole]):
                pair = pc.list_flatten(batch.column("pairs")).to_numpy()
                times = pc.list_flatten(batch.column("times")).to_numpy().astype(np.int64)
                ends = np.cumsum(np.concatenate([[0], pc.list_value_length(batch.column("pairs")).to_numpy()]))
                sums = [np.concatenate([[0], np.cumsum(v)]) for v in (times * best[pair], times * n[pair])]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in rest), *(pa.array(s[ends[1:]] - s[ends[:-1]]) for s in sums)],
                    [*rest, "n_best", "count_sum"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in aligned.schema if f.name in rest)
    return shipped(aligned).mapInArrow(run, schema + ", n_best long, count_sum long")


def op11_token_alignment(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))
    kept = align(docs).withColumn("groups_sha256", digest).drop("groups")
    return score_links(stash(kept, "aligned")).select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
