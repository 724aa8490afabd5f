"""Prefix trie of conversations by an external mergesort that carries LCPs.

A turn is a 128-bit digest of its role and text (SHA-256, cut) with a number of words, so a conversation is a
row of 16 bytes for each turn. Tasks sort bounded runs of conversations; each row carries its LCP with the row
before it, in turns, and the runs are stored as a table. The stored rows are then dealt by ranges of (sequence,
id); what one run has in a range is one piece of it in order, so its LCPs still hold, and each range merges its pieces
with a loser tree: the head with the longer LCP to the last row out is the smaller without a look at
its turns, and equal ones are compared from that LCP on. Copies of a conversation are parted by id, so a hot one
spreads over ranges.

The merged stream drives a stack of the nodes on the path open. A node that a row leaves is finished and goes
out as soon as its parent's smallest id is known, too. Only the nodes on the first and the last path of a range can be shared with
others: they go out with sums over the range. Whether such a node was opened in a range before, or stays open
after it, is an equi-join with the neighbour's path; what a range adds (members, children opened here,
leaves closed here, tokens) then adds up by node. Ids of members ending at such a node are chunks of
text in order, hashed as a stream, one row at a time.

Defined results: rows without conv_id are of no conversation. Null role and text are empty; turns come in
order, null first, ties by digest (equal turns are interchangeable). An empty table has no node, the root included. Other
columns, whatever their names, change nothing. A conversation's turns (some 24 bytes each) are one row; texts never are gathered.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import dropped, map_arrow, stored

SIZE = 16
#: Rows and bytes of sequences in a run, and in a range: bounds of a task's memory.
RUN_ROWS, RUN_BYTES = 20_000, 16 << 20
RANGE_ROWS, RANGE_BYTES = 20_000, 32 << 20
#: Ids in a chunk of a shared node's members, and rows of a batch that goes out.
CHUNK, OUT_ROWS = 50_000, 10_000
WORDS = r"[^\x20\x09-\x0D]+"


def turns(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns): the turns of each conversation in order, as structs of (turn, digest in hex, words)."""
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.length(r).cast("string"), F.lit(":"), r, t), 256), 1, 2 * SIZE)
    each = rows.where(F.col(conv).isNotNull()).select(F.col(conv).cast("long").alias("conv_id"), F.struct(F.col(turn).alias("turn"), digest.alias("digest"), F.regexp_count(t, F.lit(WORDS)).cast("long").alias("words")).alias("t"))
    return each.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))


def sequences(convs: DataFrame) -> DataFrame:
    """(conv_id, key, words) of (conv_id, turns): the digests in a row, and the words of each turn."""
    key = F.unhex(F.array_join(F.transform("turns", lambda t: t["digest"]), ""))
    return convs.select("conv_id", key.alias("key"), F.transform("turns", lambda t: t["words"]).alias("words"))


def rebuilt(convs: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Each conversation c begins with the first h turns of c - c % group, then has its own from the h-th on; h is the CRC-32 of c, modulo ``most``."""
    none = F.expr("slice(turns, 1, 0)")
    heads = convs.where(F.col("conv_id") % group == 0).select(F.col("conv_id").alias("_first"), F.slice("turns", 1, most).alias("_head"))
    joined = convs.withColumn("_first", F.col("conv_id") - F.col("conv_id") % group).join(heads, "_first", "left")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    rest = F.slice(F.col("turns"), (F.col("_h") + 1).cast("int"), F.greatest(F.size("turns") - F.col("_h"), F.lit(0)).cast("int"))
    head = F.coalesce(F.slice(F.col("_head"), F.lit(1), F.col("_h").cast("int")), none)
    return joined.withColumn("_h", h).select("conv_id", F.concat(head, rest).alias("turns"))


def lcp(a: bytes, b: bytes, at: int = 0) -> int:
    """How many turns two sequences share, of which ``at`` are known to be shared."""
    most = min(len(a), len(b)) // SIZE
    while at < most and a[at * SIZE : at * SIZE + SIZE] == b[at * SIZE : at * SIZE + SIZE]:
        at += 1
    return at


def sorted_runs(seqs: DataFrame, run_rows: int = RUN_ROWS, run_bytes: int = RUN_BYTES) -> DataFrame:
    """(run, seq, lcp, conv_id, key, words): each task's rows in sorted runs."""

    def run(batches):
        part, n = TaskContext.get().partitionId() << 32, 0
        rows, size = [], 0

        def sent():
            rows.sort(key=lambda r: r[:2])
            keys = [r[0] for r in rows]
            shared = [0, *map(lcp, keys, keys[1:])]
            for i in range(0, len(rows), OUT_ROWS):
                k = slice(i, i + OUT_ROWS)
                columns = [pa.array([part | n] * len(rows[k]), pa.int64()), pa.array(range(i, i + len(rows[k])), pa.int64()), pa.array(shared[k], pa.int32())]
                columns += [pa.array([r[1] for r in rows[k]], pa.int64()), pa.array(keys[k], pa.binary()), pa.array([r[2] for r in rows[k]], pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, names=["run", "seq", "lcp", "conv_id", "key", "words"])

        for b in batches:
            for conv, key, words in zip(*[c.to_pylist() for c in b.columns]):
                rows.append((key, conv, words))
                size += len(key)
                if len(rows) >= run_rows or size >= run_bytes:
                    yield from sent()
                    rows, size, n = [], 0, n + 1
        if rows:
            yield from sent()

    return map_arrow(seqs.select("conv_id", "key", "words"), run, "run bigint, seq bigint, lcp int, conv_id bigint, key binary, words array<bigint>")


def merged(keys: list[bytes], convs: list[int], lcps: list[int], starts: list[int]) -> Iterator[tuple[int, int]]:
    """(row, LCP with the row before) in order of (key, conv), from sorted pieces that begin at ``starts``.

    A loser tree over the pieces; ``now`` has the LCP of each piece's head with the last row out. At an inner
    node stays the piece that lost, with its LCP to the one that won there: all that later rounds ask for.
    """
    k = len(starts)
    if not k:
        return
    at, stop = list(starts), [*starts[1:], len(keys)]
    now = [0] * k
    tree = [-1] * max(k, 2)

    def beats(a: int, b: int) -> bool:
        """Whether the head of ``a`` comes before that of ``b``; the loser's LCP becomes that with the winner."""
        if at[b] >= stop[b]:
            return True
        if at[a] >= stop[a]:
            return False
        if now[a] != now[b]:
            return now[a] > now[b]
        x, y = keys[at[a]], keys[at[b]]
        n = lcp(x, y, now[a])
        first = (x, convs[at[a]]) < (y, convs[at[b]]) if n * SIZE in (len(x), len(y)) else x[n * SIZE :] < y[n * SIZE :]
        now[b if first else a] = n
        return first

    def climb(w: int) -> int:
        """Play piece ``w`` from its leaf to the top; before the tree is full, it waits at the first free node."""
        node = (w + k) >> 1
        while node:
            other = tree[node]
            if other < 0:
                tree[node] = w
                return -1
            if not beats(w, other):
                tree[node], w = w, other
            node >>= 1
        return w

    w = -1
    for piece in range(k):
        top = climb(piece)
        w = top if top >= 0 else w
    while at[w] < stop[w]:
        row = at[w]
        yield row, now[w]
        at[w] += 1
        if at[w] < stop[w]:
            now[w] = lcps[at[w]]
        w = climb(w)


class Node:
    __slots__ = ("ends", "first", "kids", "leaves", "least", "n", "n_children", "saved", "slot", "words")

    def __init__(self, words: int, first: bool, depth: int):
        self.words, self.first, self.slot = words, first, depth if first else -depth
        self.n = self.n_children = self.leaves = self.saved = 0
        self.least = None
        self.kids: list[tuple] = []  # finished children that wait for the smallest id here
        self.ends: list[int] = []  # members that end here


#: What a range sends, by ``kind``: 0 finished nodes, 1 nodes of its first or last path, 2 chunks of ids that end at those.
FIELDS = (
    "kind int, part int, slot int, parent_slot int, depth int, node binary, parent binary, conv_id bigint, parent_conv_id bigint, n_convs bigint, n_children bigint, n_leaves bigint, "
    "saved bigint, words bigint, has_children boolean, on_first boolean, on_last boolean, ends_sha256 string, seq int, ids string"
)
TYPES = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_(), "string": pa.string()}
NAMES, KINDS = zip(*[f.split() for f in FIELDS.split(", ")])
NOTHING = hashlib.sha256(b"").hexdigest()


class Path:
    """The open path of one range: rows of ``FIELDS`` come out as nodes are finished."""

    def __init__(self, part: int):
        self.part, self.stack, self.key = part, [], b""
        self.out: list[tuple] = []

    def _row(self, **values) -> tuple:
        return tuple([values.get(name) for name in NAMES])

    def add(self, key: bytes, conv: int, words: list[int], shared: int) -> None:
        first = not self.stack
        if first:
            self.stack.append(Node(0, True, 0))
        while len(self.stack) > shared + 1:
            self._close()
        for d in range(len(self.stack), len(key) // SIZE + 1):
            self.stack.append(Node(words[d - 1], first, d))
        self.key, top = key, self.stack[-1]
        top.n += 1
        top.least = conv if top.least is None else min(top.least, conv)
        top.ends.append(conv)

    def _prefix(self, depth: int) -> bytes:
        return hashlib.sha256(self.key[: depth * SIZE]).digest()[:SIZE]

    def _released(self, node: Node, slot: int | None = None) -> None:
        """The finished children of ``node`` go out: their parent's smallest id is known, or they get its slot."""
        parent = ("parent_conv_id", node.least) if slot is None else ("parent_slot", slot)
        at = NAMES.index(parent[0])
        self.out += [(*kid[:at], parent[1], *kid[at + 1 :]) for kid in node.kids]
        node.kids = []

    def _close(self, last: bool = False) -> None:
        depth = len(self.stack) - 1
        node = self.stack.pop()
        parent = self.stack[-1] if self.stack else None
        if parent:
            parent.n += node.n
            parent.least = node.least if parent.least is None else min(parent.least, node.least)
        if node.first or last:
            own = self._prefix(depth)
            self._released(node, node.slot)
            for i in range(0, len(node.ends), CHUNK):
                self.out.append(self._row(kind=2, part=self.part, node=own, seq=i, ids=",".join(map(str, node.ends[i : i + CHUNK]))))
            self.out.append(self._row(
                kind=1, part=self.part, slot=node.slot, depth=depth, node=own, parent=self._prefix(depth - 1) if depth else None, conv_id=node.least, n_convs=node.n,
                n_children=node.n_children, n_leaves=node.leaves, saved=node.saved, words=node.words, has_children=node.n > len(node.ends), on_first=node.first, on_last=last,
            ))
            if parent:  # sums over finished nodes pass up; what the node itself adds is known later
                parent.leaves += node.leaves
                parent.saved += node.saved
            return
        self._released(node)
        leaves, saved = node.leaves if node.n_children else 1, node.saved + (node.n - 1) * node.words
        ends = hashlib.sha256(",".join(map(str, node.ends)).encode()).hexdigest() if node.ends else NOTHING
        parent.n_children += 1
        parent.leaves += leaves
        parent.saved += saved
        parent.kids.append(self._row(kind=0, part=self.part, depth=depth, conv_id=node.least, n_convs=node.n, n_children=node.n_children, n_leaves=leaves, saved=saved, ends_sha256=ends))
        if parent.first:
            self._released(parent, parent.slot)

    def finish(self) -> None:
        while self.stack:
            self._close(last=True)

    def taken(self) -> pa.RecordBatch:
        columns = [pa.array(c, TYPES[k]) for c, k in zip(zip(*self.out), KINDS)]
        self.out = []
        return pa.RecordBatch.from_arrays(columns, names=list(NAMES))


def merge_ranges(runs: DataFrame, ranges: int) -> DataFrame:
    """Rows of ``FIELDS``: each range of (key, id) merges its pieces of the stored runs and sends its nodes."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, lcps, convs, keys, words = [], [], [], [], []
        for b in batches:
            for whole, column in zip((of, lcps, convs, keys, words), b.columns):
                whole += column.to_pylist()
        starts = [i for i, r in enumerate(of) if not i or r != of[i - 1]]
        path = Path(TaskContext.get().partitionId())
        for row, shared in merged(keys, convs, lcps, starts):
            path.add(keys[row], convs[row], words[row], shared)
            if len(path.out) >= OUT_ROWS:
                yield path.taken()
        path.finish()
        if path.out:
            yield path.taken()

    dealt = runs.repartitionByRange(ranges, "key", "conv_id").sortWithinPartitions("run", "seq")
    return map_arrow(dealt.select("run", "lcp", "conv_id", "key", "words"), run, FIELDS)


def _digests(chunks: DataFrame) -> DataFrame:
    """(node, ends_sha256): the chunks of each node hashed as a stream in order of (part, seq), joined by commas."""

    def run(batches):
        node, digest = None, None
        for b in batches:
            out = []
            for own, ids in zip(*[c.to_pylist() for c in b.columns]):
                if own != node:
                    if node is not None:
                        out.append((node, digest.hexdigest()))
                    node, digest = own, hashlib.sha256(ids.encode())
                else:
                    digest.update(f",{ids}".encode())
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.binary()), pa.array([r[1] for r in out], pa.string())], names=["node", "ends_sha256"])
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([digest.hexdigest()])], names=["node", "ends_sha256"])

    return map_arrow(chunks.repartition("node").sortWithinPartitions("node", "part", "seq").select("node", "ids"), run, "node binary, ends_sha256 string")


def _shared(found: DataFrame) -> DataFrame:
    """The nodes on the first and last paths of ranges, each once: node, parent and the columns of the result without digests."""
    paths = found.where("kind = 1")
    order = Window.orderBy("part")  # one row for each range
    beside = paths.where("depth = 0").select("part", F.lag("part").over(order).alias("before"), F.lead("part").over(order).alias("after"))
    lasts = paths.where("on_last").select(F.col("part").alias("before"), "node", F.lit(True).alias("on_first"), F.lit(True).alias("_open_before"))
    firsts = paths.where("on_first").select(F.col("part").alias("after"), "node", F.lit(True).alias("on_last"), F.lit(True).alias("_open_after"))
    p = paths.join(beside, "part").join(lasts, ["before", "node", "on_first"], "left").join(firsts, ["after", "node", "on_last"], "left")
    p = p.withColumn("_opened", F.col("_open_before").isNull()).withColumn("_leaf", (F.col("_open_after").isNull() & ~F.col("has_children")).cast("long"))
    p = p.withColumn("_tokens", F.col("n_convs") * F.col("words") - F.when(F.col("_opened"), F.col("words")).otherwise(0))
    # below a node are the deeper ones of its branch; a node on both paths has both branches below
    p = p.withColumn("_both", F.col("on_first") & F.col("on_last"))
    down = lambda *by: Window.partitionBy("part", *by).orderBy(F.col("depth").desc()).rangeBetween(Window.unboundedPreceding, 0)
    whole, own = down(), down("on_first", "on_last")
    under = lambda c: F.when(F.col("_both"), F.sum(c).over(whole)).otherwise(F.sum(c).over(own))
    p = p.withColumn("_leaves", F.col("n_leaves") + under("_leaf")).withColumn("_saved", F.col("saved") + under("_tokens"))
    each = p.groupBy("node").agg(
        F.first("parent").alias("parent"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"),
        F.sum("n_children").alias("n_children"), F.sum("_leaves").alias("n_leaves"), F.sum("_saved").alias("saved"),
    )
    opened = p.where("_opened and parent is not null").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("_more"))
    return each.join(opened, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("_more", F.lit(0))).drop("_more")


def trie(seqs: DataFrame, run_rows: int = RUN_ROWS, range_rows: int = RANGE_ROWS) -> DataFrame:
    """One row for each node of the prefix trie of ``seqs`` (conv_id, key, words).

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.
    """
    runs = stored(sorted_runs(seqs, run_rows), "sorted-runs")
    n, size = runs.agg(F.count("*"), F.sum(F.octet_length("key"))).first()
    ranges = max(1, -(-n // range_rows), -(-(size or 0) // RANGE_BYTES))
    found = stored(merge_ranges(runs, ranges), "trie")
    dropped(runs)
    shared = stored(_shared(found), "shared-nodes")
    parents = shared.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    ends = _digests(found.where("kind = 2"))
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), "ends_sha256"]
    tops = shared.join(parents, "parent", "left").join(ends, "node", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING))).select(*cols)
    nodes = found.where("kind = 0")
    slots = found.where("kind = 1").select("part", F.col("slot").alias("parent_slot"), "node").join(shared.select("node", F.col("conv_id").alias("_least")), "node").drop("node")
    waiting = nodes.where("parent_slot is not null").join(slots, ["part", "parent_slot"]).withColumn("parent_conv_id", F.col("_least")).select(*cols)
    return tops.unionByName(waiting).unionByName(nodes.where("parent_slot is null").select(*cols))


def conversation_trie(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **options) -> DataFrame:
    """The trie of conversations as they are."""
    return trie(sequences(turns(rows, conv, turn, role, text)), **options)


def op13_conversation_trie(rows: DataFrame, **options) -> DataFrame:
    """The trie of the conversations, each rebuilt on the head of its group."""
    out = trie(sequences(rebuilt(turns(rows))), **options)
    return out.withColumn("depth", F.col("depth").cast("long"))
