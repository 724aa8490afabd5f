"""Token counts that follow edits: a stored segment tree over each document's pre-tokens.

A document is cut before white space into leaves of about ``LEAF`` runs; no pre-token of the tokenizer file
reaches over white space, so a leaf's tokens depend on nothing outside it. The tree sums characters
and tokens. An edit finds its leaves by descending over the character sums, and only the text of these
leaves is encoded again, with the leaf before them if the edited text no longer starts with white
space (the boundary context); then the sums on their paths are updated. A leaf that has grown to
four times its size is cut again.

``build_trees`` encodes a corpus once and gives its trees as a table: the leaves' texts, and the sums of all
nodes, root first. ``apply_edits`` reads only such a table and gives the edited one, which the next round
of edits reads in turn; documents without edits aren't encoded at all. Trees of one document are one row, as
large as the document itself.

An edit is (at, cut, put): from code point ``at`` of the text as the edits before it left it, ``cut`` code points
go and ``put`` comes. Edits are applied in their order.

Defined results: a null text is empty. Positions and lengths outside the text are clamped to it; a null
``at`` or ``cut`` is 0, a null ``put`` is empty, a null list of edits has none. Repeated rows and null ids
are counted each for itself.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import LibraryEncoder, kept, runs_of
from .common import free_name, map_arrow, stored, tokenizer_path

LEAF = 32
SPACES = tuple(" \t\n\x0b\x0c\r")
_SPACE = re.compile(r"[ \t-\r]")
EDITS = "array<struct<at:bigint,cut:bigint,put:string>>"


def leaves_of(text: str, size: int = LEAF) -> list[str]:
    """``text`` in pieces of about ``size`` runs (six characters each), each but the first starting with white space."""
    at, n = [0], 6 * size
    while (m := _SPACE.search(text, at[-1] + n)) is not None:
        at.append(m.start())
    return [text[a:b] for a, b in zip(at, [*at[1:], len(text)])]


class Tree:
    """Sums of (characters, tokens) over the leaves of one document; ``count`` gives the runs and tokens of a text."""

    def __init__(self, leaves: list[str], tokens: list[int], count=None, size: int = LEAF):
        self.count, self.size = count, size
        self.encoded = 0  # runs encoded again
        self._build(list(zip(leaves, tokens)))

    @classmethod
    def stored(cls, leaves: list[str], chars: list[int], tokens: list[int], count, size: int = LEAF) -> Tree:
        """A tree as its table row has it: nothing is summed or encoded again."""
        out = cls.__new__(cls)
        out.count, out.size, out.encoded = count, size, 0
        out.text, out.chars, out.tokens, out.width = leaves, chars, tokens, len(chars) // 2
        return out

    @classmethod
    def of(cls, text: str, count, size: int = LEAF) -> Tree:
        leaves = leaves_of(text, size)
        return cls(leaves, [count(x)[1] for x in leaves], count, size)

    def _tokens(self, text: str) -> int:
        runs, tokens = self.count(text)
        self.encoded += runs
        return tokens

    def _build(self, leaves: list[tuple[str, int]]) -> None:
        self.text = [x for x, _ in leaves]
        self.width = 1 << (len(leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, (x, n) in enumerate(leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = len(x), n
        for i in range(self.width - 1, 0, -1):
            self._sum(i)

    def _sum(self, i: int) -> None:
        self.chars[i] = self.chars[2 * i] + self.chars[2 * i + 1]
        self.tokens[i] = self.tokens[2 * i] + self.tokens[2 * i + 1]

    def _set(self, leaf: int, text: str, tokens: int) -> None:
        self.text[leaf] = text
        i = self.width + leaf
        self.chars[i], self.tokens[i] = len(text), tokens
        while i > 1:
            i //= 2
            self._sum(i)

    def _find(self, at: int) -> tuple[int, int]:
        """The leaf of code point ``at`` (the last leaf at the end) and the offset in it."""
        i = 1
        while i < self.width:
            i *= 2
            if at >= self.chars[i] and self.chars[i + 1]:
                at -= self.chars[i]
                i += 1
        return i - self.width, at

    @property
    def total(self) -> int:
        return self.tokens[1]

    def edit(self, at: int | None, cut: int | None, put: str | None) -> None:
        length = self.chars[1]
        at = min(max(at or 0, 0), length)
        cut = min(max(cut or 0, 0), length - at)
        first, offset = self._find(at)
        last, end = self._find(at + cut)
        region = "".join(self.text[first : last + 1])
        tail = len(self.text[last]) - end
        region = region[:offset] + (put or "") + region[len(region) - tail :]
        while first and region[:1] not in SPACES:
            first -= 1
            region = self.text[first] + region
        # what follows starts with white space, or is empty
        for leaf in range(first + 1, last + 1):
            if self.text[leaf]:
                self._set(leaf, "", 0)
        pieces = leaves_of(region, self.size)
        if len(pieces) < 4:
            self._set(first, region, self._tokens(region))
        else:
            known = [(x, self.tokens[self.width + i]) for i, x in enumerate(self.text)]
            fresh = [(x, self._tokens(x)) for x in pieces]
            self._build(known[:first] + fresh + [k for k in known[first + 1 :] if k[0]])


_ROW = [("leaves", pa.list_(pa.string())), ("chars", pa.list_(pa.int64())), ("tokens", pa.list_(pa.int64()))]
_TREE = "leaves array<string>, chars array<bigint>, tokens array<bigint>"
_COUNTS = ["n_tokens", "n_edits", "n_tokens_after", "n_chars_after", "n_leaves", "n_runs_encoded_again"]


def _tokenizer(docs: DataFrame, path: str | None):
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def _counter(shared) -> Counter:
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return kept(("counter", shared.value), lambda: Counter(shared.value))


def build_trees(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, leaves, chars, tokens) for each row of ``docs``: the leaves' texts, and both sums of every node, from place 1, the root, on."""
    shared = _tokenizer(docs, path)

    def run(batches):
        counter = _counter(shared)
        for b in batches:
            leaves = [leaves_of(t.as_py() or "") for t in b.column(1)]
            _, ends = counter.encode(pa.array([x for own in leaves for x in own], pa.string()))
            tokens, at, rows = np.diff(ends, prepend=0).tolist(), 0, []
            for own in leaves:
                tree = Tree(own, tokens[at : at + len(own)])
                at += len(own)
                rows.append((tree.text, tree.chars, tree.tokens))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, (_, t) in zip(zip(*rows), _ROW))], names=["id", *[n for n, _ in _ROW]])

    return map_arrow(docs.select(id_col, text), run, f"id {docs.schema[id_col].dataType.simpleString()}, {_TREE}")


def apply_edits(trees: DataFrame, edits: Column, path: str | None = None, with_trees: bool = True) -> DataFrame:
    """The rows of ``trees`` (``build_trees``, or what this gave and was stored) after ``edits``, a column of ``EDITS`` over them.

    Beside the new tree: n_tokens and n_tokens_after (before and after), n_edits, n_chars_after, n_leaves (before), and
    n_runs_encoded_again. No text is read but the leaves, and none is encoded but those that edits touch. Without
    ``with_trees`` only the id and the counts come out.
    """
    shared = _tokenizer(trees, path)
    new = _ROW if with_trees else []
    names = ["id", *[n for n, _ in new], *_COUNTS]

    def run(batches):
        counter = _counter(shared)
        for b in batches:
            lists = b.column(4).to_pylist()
            counter.learn([(e or {}).get("put") for x in lists for e in x or []])
            rows = []
            for i, x in enumerate(lists):
                leaves, chars, tokens = (b.column(k)[i].values for k in (1, 2, 3))
                tree, n = Tree.stored(leaves.to_pylist(), chars.to_numpy().tolist(), tokens.to_numpy().tolist(), counter), len(leaves)
                before = tree.total
                for e in x or []:
                    if e is not None:
                        tree.edit(e["at"], e["cut"], e["put"])
                rows.append((*((tree.text, tree.chars, tree.tokens) if with_trees else ()), before, len(x or []), tree.total, tree.chars[1], n, tree.encoded))
            kinds = [t for _, t in new] + [pa.int64()] * len(_COUNTS)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(list(c), t) for c, t in zip(zip(*rows), kinds))], names=names)

    schema = f"id {trees.schema['id'].dataType.simpleString()}, {_TREE + ', ' if with_trees else ''}" + ", ".join(f"{n} bigint" for n in _COUNTS)
    return map_arrow(trees.select("id", "leaves", "chars", "tokens", edits.cast(EDITS).alias("_edits")), run, schema)


def edited_counts(docs: DataFrame, edits: Callable[[Column, Column], Column], path: str | None = None, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``docs``: id and the counts of ``apply_edits``. The trees are built and stored first.

    ``edits`` makes a column of ``EDITS`` from the columns of a document's id and length. Edits that are a table
    of their own join the trees by ``edit_lists``.
    """
    trees = stored(build_trees(docs, path, id_col, text), "trees")
    return apply_edits(trees, edits(F.col("id"), F.col("chars")[1]), path, with_trees=False)


class Counter(LibraryEncoder):
    """Tokens of texts, by the tokenizers library; recent runs are remembered."""

    def learn(self, texts: list[str | None]) -> None:
        """Encode all runs of the texts that aren't known, together."""
        self.recall(runs_of(pa.array(texts, pa.string()))[1].dictionary.to_pylist())

    def __call__(self, text: str) -> tuple[int, int]:
        """(runs, tokens) of a text."""
        raw = text.encode("utf-8", "surrogatepass")
        runs = raw.split()
        if not runs:
            return 0, 0
        if raw.isascii() and b"<|" not in raw:
            keys = b" ".join(runs).lower().decode().split(" ")
        else:
            keys = [r.lower().decode() if r.isascii() and b"<|" not in r else r.decode() for r in runs]
        found = list(map(self.young.get, keys))
        if None in found:
            found = self.recall(keys)
        return len(runs), sum(map(len, found)) // 4


def edit_lists(trees: DataFrame, edits: DataFrame, edit_id: str = "doc_id") -> tuple[DataFrame, Column]:
    """``trees`` joined with the rows (id, seq, at, cut, put) of ``edits``, and the column of their edits in order of seq.

    The column has a name that ``trees`` doesn't. Edits of a null id go to the trees of null ids.
    """
    name = free_name(trees, "edits")
    of = edits.groupBy(F.col(edit_id).alias("_of")).agg(F.array_sort(F.collect_list(F.struct("seq", "at", "cut", "put"))).alias("_list"))
    of = of.select("_of", F.transform("_list", lambda e: F.struct(e["at"].alias("at"), e["cut"].alias("cut"), e["put"].alias("put"))).alias(name))
    return trees.join(of, trees["id"].eqNullSafe(of["_of"]), "left").drop("_of"), F.col(name)


def scripted(id_col: Column, length: Column) -> Column:
    """The edits of the registered query: an insertion, a deletion, a replacement that may join words, and an addition."""
    n = length.cast("long")
    name = F.coalesce(id_col.cast("string"), F.lit("null"))
    at = F.pmod(F.crc32(name.cast("binary")), n + 1)

    def edit(at: Column, cut: int, put: Column) -> Column:
        return F.struct(at.cast("long").alias("at"), F.lit(cut).cast("long").alias("cut"), put.alias("put"))

    return F.array(
        edit(F.floor(n / 3), 0, F.lit(" inserted words,")),
        edit(F.floor(2 * n / 3), 17, F.lit("")),
        edit(at, 5, F.concat(F.lit("x"), name)),
        edit(n * 2, 0, F.lit("\nAdded at the end.")),
    )


def op3_edit_aware_counts(docs: DataFrame) -> DataFrame:
    return edited_counts(docs, scripted).withColumnRenamed("id", "doc_id")
