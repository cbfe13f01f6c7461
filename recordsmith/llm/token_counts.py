"""Edit-aware token counts (operator 6).

A document is kept as the leaves of a segment tree: stretches of text cut where no match of
the vocabulary's pattern can reach across -- before a space behind other text and, under the
pattern of the public tokenizers, wherever letters, digits and other signs meet, so that
texts without spaces have leaves too -- each with its token count. An edit replaces a range of characters. Only the leaves it touches are encoded
again, widened by a neighbour wherever the edit has spoiled the cut between them; the sums
of characters and tokens are updated along the paths to the root.
"""

from __future__ import annotations

from functools import lru_cache

import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordsmith.llm.bpe import ByteBpe, default_vocabulary, load_coder
from recordsmith.llm.common import map_slices, read_table

LEAF_CHARS = 256         # least characters of a leaf, but for the last
GROWN = 8                # a leaf over so many times that is cut anew
TREE = "doc_id long, leaves array<string>, tokens array<long>, n_tokens long"


# Matches of the public pattern are runs of letters, of digits or of other signs, with at most
# one space before; only an apostrophe can be matched together with the letters behind it.
_BORDERS = regex.compile(ByteBpe.CUT.pattern + r"|(?<=\p{L})(?=[^\s\p{L}])|(?<=\p{N})(?=[^\s\p{N}])"
                         r"|(?<=[^\s\p{L}\p{N}'])(?=[\p{L}\p{N}])")


def borders(pattern: str):
    """Where a text may be cut without changing the matches of a pattern."""
    return _BORDERS if pattern == public_tokenizers.PATTERN else ByteBpe.CUT


@lru_cache(maxsize=1 << 16)
def _safe(cut, before: str, after: str) -> bool:
    return bool(before and after and cut.match(before + after, 1))


def cut_leaves(text: str, cut=_BORDERS) -> list[str]:
    """Stretches of a text between safe cuts, LEAF_CHARS or more each."""
    leaves, start = [], 0
    while len(text) - start > LEAF_CHARS:
        found = cut.search(text, start + LEAF_CHARS)
        if found is None:
            break
        leaves.append(text[start:found.start()])
        start = found.start()
    if start < len(text) or not leaves:
        leaves.append(text[start:])
    return leaves


class TokenTree:
    """Sums of characters and tokens over the leaves of one document."""

    def __init__(self, coder: ByteBpe, leaves: list[str], tokens: list[int] | None = None, cut=_BORDERS):
        self.coder, self.encoded, self.cut = coder, 0, cut
        self._build(leaves, tokens or [self._count(x) for x in leaves])

    def _count(self, text: str) -> int:
        self.encoded += len(text)
        return len(self.coder.encode(text)) // 4

    def _build(self, leaves: list[str], tokens: list[int]) -> None:
        self.leaves, self.base = leaves, 1 << max(0, len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.base), [0] * (2 * self.base)
        for k, (text, n) in enumerate(zip(leaves, tokens)):
            self.chars[self.base + k], self.tokens[self.base + k] = len(text), n
        for k in range(self.base - 1, 0, -1):
            self._sum(k)

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def _set(self, leaf: int, text: str, n: int) -> None:
        self.leaves[leaf], k = text, self.base + leaf
        self.chars[k], self.tokens[k] = len(text), n
        while k > 1:
            k //= 2
            self._sum(k)

    def _find(self, at: int) -> tuple[int, int]:
        """(leaf, offset in it) of a character; the end of the text is in its last leaf."""
        if at >= self.chars[1]:
            last = len(self.leaves) - 1
            return last, at - (self.chars[1] - len(self.leaves[last]))
        k = 1
        while k < self.base:
            k *= 2
            if at >= self.chars[k]:
                at -= self.chars[k]
                k += 1
        return k - self.base, at

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    @property
    def text(self) -> str:
        return "".join(self.leaves)

    def edit(self, start: int, stop: int, new: str) -> None:
        """Replace characters [start, stop), held to the text, by ``new``."""
        size = self.chars[1]
        start = min(max(start, 0), size)
        stop = min(max(stop, start), size)
        i, a = self._find(start)
        j, z = self._find(stop - 1) if stop > start else (i, a - 1)
        region = self.leaves[i][:a] + new + self.leaves[j][z + 1:]
        last = len(self.leaves) - 1
        # Cuts that the edit has spoiled, before and behind the region, go.
        while i > 0 and not _safe(self.cut, self.leaves[i - 1][-1:], region[:1]):
            i -= 1
            region = self.leaves[i] + region
        while j < last and not _safe(self.cut, region[-1:], self.leaves[j + 1][:1]):
            j += 1
            region += self.leaves[j]
        if len(region) > GROWN * LEAF_CHARS:
            pieces = cut_leaves(region, self.cut)
            tokens = self.tokens[self.base:self.base + len(self.leaves)]
            self._build(self.leaves[:i] + pieces + self.leaves[j + 1:],
                        tokens[:i] + [self._count(x) for x in pieces] + tokens[j + 1:])
            return
        self._set(i, region, self._count(region))
        for k in range(i + 1, j + 1):
            self._set(k, "", 0)


def token_trees(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
                vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, leaves, tokens, n_tokens) of every row. A null text counts as empty: one
    empty leaf of 0 tokens."""
    path, pattern = vocabulary or default_vocabulary()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load_coder(path, pattern)
        cut = borders(pattern)
        trees = [TokenTree(coder, cut_leaves(t or "", cut), None, cut) for t in batch.column("text").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([t.leaves for t in trees], pa.list_(pa.string())),
             pa.array([t.tokens[t.base:t.base + len(t.leaves)] for t in trees], pa.list_(pa.int64())),
             pa.array([t.n_tokens for t in trees], pa.int64())], ["doc_id", "leaves", "tokens", "n_tokens"])

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    return map_slices(source, run, TREE, "text")


def _edited(tree: TokenTree, edits: list | None) -> TokenTree:
    for e in edits or []:
        tree.edit(e["start"], e["stop"], e["replacement"])
    return tree


def _as_edit(seq, start, stop, replacement) -> Column:
    """An edit as ``apply_edits`` takes it: null bounds are 0, a null replacement is empty."""
    return F.struct(seq.alias("seq"), F.coalesce(start, F.lit(0)).cast("long").alias("start"),
                    F.coalesce(stop, F.lit(0)).cast("long").alias("stop"),
                    F.coalesce(replacement, F.lit("")).alias("replacement"))


def edited_counts(df: DataFrame, edits: Column, doc_id: str = "doc_id", text: str = "text",
                  vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_before, n_tokens, n_edits, chars_encoded) of every row after the edits in its
    own array column ``edits`` (structs of ``_as_edit``, taken in the order of seq).

    Trees are built, edited and summed up where the row is; nothing is shuffled, and rows that
    share an id do not meet. A null text is empty, a null array means no edits.
    """
    path, pattern = vocabulary or default_vocabulary()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder, cut, out = load_coder(path, pattern), borders(pattern), []
        for t, edits in zip(batch.column("text").to_pylist(), batch.column("edits").to_pylist()):
            tree = TokenTree(coder, cut_leaves(t or "", cut), None, cut)
            before, tree.encoded = tree.n_tokens, 0
            out.append((before, _edited(tree, edits).n_tokens, len(edits or []), tree.encoded))
        columns = list(zip(*out)) or [()] * 4
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                                          ["doc_id", "n_before", "n_tokens", "n_edits", "chars_encoded"])

    source = df.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"),
                       F.sort_array(edits).alias("edits"))
    return map_slices(source, run, "doc_id long, n_before long, n_tokens long, n_edits long, chars_encoded long", "text")


def apply_edits(trees: DataFrame, edits: DataFrame, vocabulary: tuple[str, str] | None = None) -> DataFrame:
    """Trees after their edits, with ``n_before``, ``n_edits`` and ``chars_encoded``.

    ``edits`` has (doc_id, seq, start, stop, replacement); the edits of a document follow
    each other in order of seq (ties by the other columns), each on the text that the last
    one left. Ranges are held to the text, a null bound or replacement counts as 0 or
    empty; edits of unknown or null ids do nothing, documents without edits stay as they
    are, and rows that share an id all get the edits of that id.
    """
    path, pattern = vocabulary or default_vocabulary()
    edit = _as_edit(*(F.col(c) for c in ("seq", "start", "stop", "replacement")))
    listed = (edits.where("doc_id IS NOT NULL").groupBy("doc_id")
              .agg(F.sort_array(F.collect_list(edit)).alias("edits")))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        coder = load_coder(path, pattern)
        out = []
        for leaves, tokens, edits in zip(*(batch.column(c).to_pylist() for c in ("leaves", "tokens", "edits"))):
            out.append(_edited(TokenTree(coder, leaves, tokens, borders(pattern)), edits))
        n = [len(e or []) for e in batch.column("edits").to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array([t.leaves for t in out], pa.list_(pa.string())),
             pa.array([t.tokens[t.base:t.base + len(t.leaves)] for t in out], pa.list_(pa.int64())),
             pa.array([t.n_tokens for t in out], pa.int64()), batch.column("n_tokens"),
             pa.array(n, pa.int64()), pa.array([t.encoded for t in out], pa.int64())],
            ["doc_id", "leaves", "tokens", "n_tokens", "n_before", "n_edits", "chars_encoded"])

    return map_slices(trees.join(listed, "doc_id", "left"), run,
                      TREE + ", n_before long, n_edits long, chars_encoded long", "leaves")


def derived_edits() -> Column:
    """Three edits of a document, made from its own row: its source in place of twelve
    characters after the first third, its beginning repeated in the middle, and its last
    seven characters deleted."""
    size = F.length(F.coalesce("text", F.lit("")))
    third, half = F.floor(size / 3), F.floor(size / 2)
    return F.array(
        _as_edit(F.lit(1), third, third + 12, F.col("source")),
        _as_edit(F.lit(2), half, half, F.substring(F.coalesce("text", F.lit("")), 1, 20)),
        _as_edit(F.lit(3), size - 7, size + 64, F.lit("")))


def op6_token_counts(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return edited_counts(docs, derived_edits()).select(
        "doc_id", F.col("n_before").alias("n_tokens_before"), F.col("n_tokens").alias("n_tokens_after"), "n_edits", "chars_encoded")
