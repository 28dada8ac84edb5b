"""Token counts that follow edits: a tree of pre-token runs per document (operator 7)."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .packing import Encoder, default_tokenizer

LEAF_PRETOKENS = 48
SPLIT_PRETOKENS = 4 * LEAF_PRETOKENS
CACHE_ENTRIES, CACHE_CHARS = 300_000, 64
SLICE_ROWS = 256
TREE_NAMES = ["leaf_chars", "leaf_pretokens", "leaf_tokens"]
FIGURES = ["tokens_before", "tokens_after", "pretokens", "recounted"]


class Counter:
    """Pre-tokens of a text and their token counts."""

    def __init__(self, path: str) -> None:
        import public_tokenizers

        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.encoder, self.known = Encoder(path, end=b""), {}

    def split(self, text: str, follow: str = "") -> list[str]:
        """The pre-tokens of a text after which ``follow`` comes: one character is as far as the pattern looks ahead."""
        found = self.pattern.findall(text + follow)
        if follow:
            found[-1] = found[-1][: -len(follow)]
            if not found[-1]:
                found.pop()
        return found

    def counts(self, pretokens: list[str]) -> list[int]:
        known = self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
        out = []
        for p in pretokens:
            n = known.get(p)
            if n is None:
                n = self.encoder.count(p)
                if len(p) <= CACHE_CHARS:
                    known[p] = n
            out.append(n)
        return out


@lru_cache(maxsize=1)
def counter(path: str) -> Counter:
    return Counter(path)


class TokenTree:
    """Sums of characters, pre-tokens and tokens over the runs of a text, in a binary heap.

    A leaf is a run of about ``LEAF_PRETOKENS`` pre-tokens. Node i sums nodes 2i and 2i + 1.
    """

    def __init__(self, pieces: list[str], sizes: np.ndarray) -> None:
        self.pieces = pieces
        self.base = 1 << max(0, len(pieces) - 1).bit_length()
        self.sums = np.zeros((2 * self.base, 3), np.int64)
        self.sums[self.base : self.base + len(pieces)] = sizes
        for i in range(self.base - 1, 0, -1):
            self.sums[i] = self.sums[2 * i] + self.sums[2 * i + 1]
        self.recounted = 0

    @classmethod
    def build(cls, text: str, count: Counter) -> TokenTree:
        pieces, sizes = [], []
        pretokens = count.split(text)
        for at in range(0, len(pretokens), LEAF_PRETOKENS):
            run = pretokens[at : at + LEAF_PRETOKENS]
            pieces.append("".join(run))
            sizes.append((len(pieces[-1]), len(run), sum(count.counts(run))))
        return cls(pieces or [""], np.array(sizes or [(0, 0, 0)], np.int64))

    @property
    def text(self) -> str:
        return "".join(self.pieces)

    @property
    def chars(self) -> int:
        return int(self.sums[1, 0])

    @property
    def tokens(self) -> int:
        return int(self.sums[1, 2])

    def leaves(self) -> np.ndarray:
        return self.sums[self.base : self.base + len(self.pieces)]

    def find(self, position: int) -> tuple[int, int]:
        """The leaf that holds a character, and its place in it; the end belongs to the last leaf."""
        if position >= self.chars:
            return len(self.pieces) - 1, len(self.pieces[-1])
        node = 1
        while node < self.base:
            node *= 2
            if position >= self.sums[node, 0]:
                position -= int(self.sums[node, 0])
                node += 1
        return node - self.base, position

    def _set(self, leaf: int, piece: str, pretokens: list[str], tokens: list[int]) -> None:
        self.pieces[leaf] = piece
        node = leaf + self.base
        self.sums[node] = len(piece), len(pretokens), sum(tokens)
        while node := node // 2:
            self.sums[node] = self.sums[2 * node] + self.sums[2 * node + 1]

    def edit(self, position: int, removed: int, inserted: str, count: Counter) -> None:
        """Replace ``removed`` characters from ``position``; both are cut to the text.

        The leaves touched are split anew with one leaf of context on either side. Where the first or last pre-token of
        that stretch comes out otherwise than before, the border may have moved, and the context grows by a leaf.
        """
        position = min(max(position, 0), self.chars)
        removed = min(max(removed, 0), self.chars - position)
        first, at = self.find(position)
        last = self.find(position + removed)[0]
        before = "".join(self.pieces[first : last + 1])
        after = before[:at] + inserted + before[at + removed :]
        left, right = max(0, first - 1), min(len(self.pieces) - 1, last + 1)
        while True:
            head, tail = "".join(self.pieces[left:first]), "".join(self.pieces[last + 1 : right + 1])
            follow = self.pieces[right + 1][:1] if right + 1 < len(self.pieces) else ""
            new, old_head, old_tail = count.split(head + after + tail, follow), count.split(head), count.split(tail, follow)
            if left and not (old_head and len(old_head[0]) < len(head) and new and new[0] == old_head[0]):
                left -= 1
            elif right < len(self.pieces) - 1 and not (old_tail and len(old_tail[-1]) < len(tail) and new and new[-1] == old_tail[-1]):
                right += 1
            else:
                break
        self.recounted += len(new)
        share = -(-len(new) // (right - left + 1)) if new else 1
        if share > SPLIT_PRETOKENS:
            # The stretch has outgrown its leaves: a new heap over all leaves, of which only these are counted.
            tokens = count.counts(new)
            runs = range(0, len(new), LEAF_PRETOKENS)
            pieces = ["".join(new[i : i + LEAF_PRETOKENS]) for i in runs]
            sizes = [(len(p), len(new[i : i + LEAF_PRETOKENS]), sum(tokens[i : i + LEAF_PRETOKENS])) for p, i in zip(pieces, runs, strict=True)]
            leaves, recounted = self.leaves(), self.recounted
            self.__init__(self.pieces[:left] + pieces + self.pieces[right + 1 :], np.concatenate([leaves[:left], np.array(sizes), leaves[right + 1 :]]))
            self.recounted = recounted
            return
        for k, leaf in enumerate(range(left, right + 1)):
            run = new[k * share : (k + 1) * share]
            self._set(leaf, "".join(run), run, count.counts(run))


def with_trees(docs: DataFrame, text_col: str = "text", tokenizer: str | None = None) -> DataFrame:
    """``docs`` with the leaves of each text's tree, in three arrays; null is empty. Write the result to keep the trees."""
    place, names = docs.columns.index(text_col), docs.columns

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer or default_tokenizer())
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                leaves = [TokenTree.build(t or "", count).leaves() for t in batch.column(place).to_pylist()]
                arrays = [pa.array([x[:, c].tolist() for x in leaves], pa.list_(pa.int32())) for c in range(3)]
                yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*names, *TREE_NAMES])

    leaves = [StructField(name, ArrayType(IntegerType())) for name in TREE_NAMES]
    return docs.mapInArrow(build, StructType([*docs.schema.fields, *leaves]))


def apply_edits(trees: DataFrame, text_col: str = "text", edits_col: str = "edits", tokenizer: str | None = None) -> DataFrame:
    """``trees`` with text and tree after the edits, and ``tokens_before``, ``tokens_after``, ``pretokens``, ``recounted``.

    ``edits`` is an array of structs ``position, removed, inserted`` in characters, applied one after the other, each to the
    text that the former ones left; null edits and nulls inside them do nothing. Only the stretches touched and their context are
    encoded again: ``recounted`` of them, of ``pretokens`` in the end. The text is not split outside of them; the tree comes from its leaves.
    """
    names = [c for c in trees.columns if c != edits_col]
    text_at, edits_at = trees.columns.index(text_col), trees.columns.index(edits_col)
    leaf_at = [trees.columns.index(n) for n in TREE_NAMES]

    def change(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counter(tokenizer or default_tokenizer())
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(at, SLICE_ROWS)
                changed, figures = [], []
                leaves = zip(*(batch.column(c).to_pylist() for c in leaf_at), strict=True)
                for text, edits, sizes in zip(batch.column(text_at).to_pylist(), batch.column(edits_at).to_pylist(), leaves, strict=True):
                    ends = np.cumsum(sizes[0]).tolist()
                    pieces = [(text or "")[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]
                    tree = TokenTree(pieces, np.array(sizes, np.int64).T)
                    before = tree.tokens
                    for e in edits or []:
                        if e:
                            tree.edit(e["position"] or 0, e["removed"] or 0, e["inserted"] or "", count)
                    changed.append((tree.text, *tree.leaves().T.tolist()))
                    figures.append((before, tree.tokens, int(tree.sums[1, 1]), tree.recounted))
                new = dict(zip([text_col, *TREE_NAMES], zip(*changed, strict=True), strict=True))
                columns = [pa.array(new[n], batch.schema.field(n).type) if n in new else batch.column(trees_columns.index(n)) for n in names]
                yield pa.RecordBatch.from_arrays([*columns, *(pa.array(c, pa.int64()) for c in zip(*figures, strict=True))], [*names, *FIGURES])

    trees_columns, fields = trees.columns, [f for f in trees.schema.fields if f.name != edits_col]
    return trees.mapInArrow(change, StructType([*fields, *(StructField(name, LongType()) for name in FIGURES)]))


def sample_edits(text: Column, seed: Column, count: int = 3) -> Column:
    """Edits that a text's own content gives: some characters make place for a passage from elsewhere in it."""
    length = F.greatest(F.char_length(text), F.lit(1)).cast("long")

    def one(k: int) -> Column:
        at, source = F.pmod(F.xxhash64(seed, F.lit(k)), length), F.pmod(F.xxhash64(seed, F.lit(-1 - k)), length)
        inserted = F.substring(text, source.cast("int") + 1, F.lit(37 - k))
        return F.struct(at.cast("int").alias("position"), F.pmod(F.xxhash64(seed, F.lit(100 + k)), F.lit(40)).cast("int").alias("removed"), inserted.alias("inserted"))

    return F.array(*[one(k) for k in range(count)])


def op7_token_trees(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.withColumn("edits", sample_edits(F.col("text"), F.col("doc_id")))
    return apply_edits(with_trees(docs)).select("doc_id", *FIGURES)
