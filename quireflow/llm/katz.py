"""Katz backoff language model of any order (``ORDER`` words by default), learned and applied at corpus scale.

Tokens are a text's words, A-Z lower-cased, and one end; a text's first tokens have starts before them. Counts
are discounted by Good-Turing (counts up to ``K``; above, none), each order with its own counts of counts. With
h the words before w, h' without its earliest, r = c(h, w), C(h) what was seen after h, d the discounts:

    P(w | h) = d_r r / C'(h)               if r > 0
             = alpha(h) P(w | h')          if C(h) > 0
             = P(w | h')                   if h was never a history

down to P(w) = d_c c(w) / N for known words; what the discounts leave there is the one type "unknown". C'(h) is
C(h), and one more for a history seen over ``K`` times: such a one may have no discounted count, and so it leaves
something all the same. alpha(h) is the mass left at h over the mass that P(. | h') gives to words not seen after
h, summed exactly, so every history's distribution over the V known tokens and "unknown" sums to 1, at each order.

Where the counts of counts of an order don't allow Good-Turing (a zero, or a discount outside 0 to 1), that order
takes the absolute discount D = (n1 + 1) / (n1 + 2 n2 + 2), d_r = 1 - D / r; the column ``discounts`` says which was used.

Layout. Texts become chunks of ``CHUNK_TOKENS`` tokens, about (a stored table: word hashes by frequency, tokens as
numbers into them). A gram's key is 64 bits made of its words' hashes. A chunk asks for each of its distinct
grams once, words and pairs first, then order by order; requests go to buckets by key, whose number follows the size
of the corpus (``BUCKET_BYTES``); a bucket's task adds the counts and answers in the order asked, with two bits: whether
this chunk is the one of all that speaks for the gram, and whether a held-out text has it. These answers are the
count tables, stored. Of three words and more, a gram isn't sent whose count is known: a learned one whose history or
lower gram was seen once was seen once itself, and if no held-out text has both, nobody asks for it.

The speakers then add up, for histories that a held-out text has, the discounted and the lower-order
mass; the sums meet at the histories' buckets, and held-out chunks get those they need. Learned texts need no sums.
A gram that half the corpus has is one entry for each chunk, so hot keys neither skew a task nor grow with their
occurrences. Tables and shuffle files that the next step doesn't need are dropped.

Defined results: a null or empty text is one end token. A null id is never held out. Repeated rows count
each. With no training text all words are unknown and score and base are still defined. Empty table:
empty result.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import dropped, map_arrow, stored, words_of
from .exchange import cuts, hashes, mixed, pack, pack_bits, pack_few, pack_ranks, parts_for, spread, unpack, unpack_bits, unpack_few, unpack_ranks

K = 5
ORDER = 3
CHUNK_TOKENS = 1_250_000
#: Packed requests that a bucket should hold, and about how many bytes a gram's request takes.
BUCKET_BYTES, REQUEST_BYTES = 24 << 20, 8
#: What a task should read, if the session's shuffle partitions would give it more.
TASK_BYTES = 256 << 20
END, START = hashes([b"\n", b" "])  # no word has these

_MESSAGE = "kind int, bucket int, chunk bigint, a binary, b binary, c binary, stats array<bigint>"
_FIELDS = [("kind", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()), ("a", pa.binary()), ("b", pa.binary()), ("c", pa.binary()), ("stats", pa.list_(pa.int64()))]
#: Added to an order: requests for sums of its histories, and their answers.
ASKED, SUMMED = 100, 200


def _messages(rows: list[tuple]) -> pa.RecordBatch:
    rows = [r + (None,) * (len(_FIELDS) - len(r)) for r in rows]
    columns = [pa.array(list(c), t) for c, (_, t) in zip(zip(*rows) if rows else [[]] * len(_FIELDS), _FIELDS)]
    return pa.RecordBatch.from_arrays(columns, names=[n for n, _ in _FIELDS])


def _table(rows: list[tuple]) -> pa.Table:
    return pa.Table.from_batches([_messages(rows)])


def discounts(n: list[int], k: int = K) -> tuple[list[float], str]:
    """(d_0 .. d_k, how) from the numbers n_1 .. n_(k+1) of things seen so often."""
    if all(n[: k + 1]):
        common = (k + 1) * n[k] / n[0]
        if common < 1:
            d = [((r + 1) * n[r] / (r * n[r - 1]) - common) / (1 - common) for r in range(1, k + 1)]
            if all(0 < x < 1 for x in d):
                return [1.0, *d], "good-turing"
    absolute = (n[0] + 1) / (n[0] + 2 * n[1] + 2)
    return [1.0] + [1 - absolute / r for r in range(1, k + 1)], "absolute"


class Model:
    """What all chunks share: the totals and the discounts of each order."""

    def __init__(self, total: int, types: int, starts: int, counts: list[list[int]]):
        self.total, self.types, self.starts = total, types, starts
        found = [discounts(n) for n in counts]
        self.d = [np.array(d) for d, _ in found]
        self.how = ",".join(how for _, how in found)
        n = counts[0]
        left = sum((1 - self.d[0][r]) * r * n[r - 1] for r in range(1, K + 1))
        self.denominator = float(total) if left > 0 else total + 1.0
        self.unknown = (left if left > 0 else 1.0) / self.denominator

    def discounted(self, order: int, r: np.ndarray) -> np.ndarray:
        return r * self.d[order - 1][np.where(r <= K, r, 0)]

    def word(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, self.discounted(1, c) / self.denominator, self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c.astype(np.float64) + 1) / (self.total + self.types + 1))


def whole(c: np.ndarray) -> np.ndarray:
    """C'(h) from C(h)."""
    return (c + (c > K)).astype(np.float64)


def chunks(docs: DataFrame, held: str, id_col: str, text: str) -> DataFrame:
    """The chunk table: chunk, ids, held, lens (tokens with end), words (their hashes, frequent ones first), tokens (packed ranks)."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches):
        part, n, total = TaskContext.get().partitionId(), 0, 0
        number: dict[bytes, int] = {}
        ids, out, lens, tokens = [], [], [], []
        types = None

        def flush():
            words = np.concatenate([hashes(list(number)), np.array([END, START])])
            flat = np.concatenate(tokens)
            flat = np.where(flat < 0, len(number), flat)
            order = np.argsort(-np.bincount(flat, minlength=len(words)), kind="stable")
            rank = np.empty(len(words), np.int64)
            rank[order] = np.arange(len(words))
            row = [part << 32 | n, ids, out, lens, words[order].tobytes(), pack_ranks(rank[flat])]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types)], names=["chunk", "ids", "held", "lens", "words", "tokens"])

        for b in batches:
            types = types or [pa.int64(), pa.list_(b.schema.field(0).type), pa.list_(pa.bool_()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            for i, t, x in zip(b.column(0), b.column(1), b.column(2)):
                words = words_of(t.as_py())
                own = np.fromiter((number.setdefault(w.lower(), len(number)) for w in words), np.int32, len(words))
                tokens.append(np.append(own, np.int32(-1)))  # -1 is the end
                ids.append(i.as_py())
                out.append(x.as_py())
                lens.append(len(own) + 1)
                total += len(own) + 1
                if total >= CHUNK_TOKENS:
                    yield flush()
                    n, total = n + 1, 0
                    number.clear()
                    ids, out, lens, tokens = [], [], [], []
        if ids:
            yield flush()

    schema = f"chunk bigint, ids array<{kind}>, held array<boolean>, lens array<bigint>, words binary, tokens binary"
    return stored(map_arrow(docs.select(id_col, text, F.expr(held).alias("held")), run, schema), "chunks")


class Grams:
    """The distinct grams of each order k of a chunk, at place k - 1 of each list, sorted by key.

    ``place``: each token's gram. ``lower``, ``history``: of each gram, the gram of order k - 1 that ends as it does, and
    the one before its last word. ``train``: how often training texts have it; ``held``: whether a held-out one does.
    ``start``: the place of the gram of starts alone, which is a history only.
    """

    def __init__(self, row: dict, order: int):
        words, number = np.unique(np.frombuffer(row["words"], np.uint64), return_inverse=True)
        tokens = number.astype(np.int32)[unpack_ranks(row["tokens"])]
        self.lens, self.out = np.array(row["lens"], np.int64), np.array(row["held"], bool)
        text, pad = np.repeat(np.arange(len(self.lens)), self.lens), order - 1
        real = np.arange(len(tokens)) + pad * (text + 1)
        run = START  # the key of starts alone
        h = np.full(len(tokens) + pad * len(self.lens), START, np.uint64)
        h[real] = words[tokens]
        learns = ~self.out[text]
        self.keys, self.place, self.train, self.held = [words], [tokens], [], []
        self.lower, self.history, self.start = [np.empty(0, np.int64)], [np.empty(0, np.int64)], [int(np.searchsorted(words, START))]
        g = h
        for k in range(2, order + 1):
            before = g
            g = np.zeros(len(h), np.uint64)
            g[k - 1 :] = mixed(before[k - 1 :] ^ mixed(h[: len(h) - k + 1], 50 + k), k)
            run = mixed(np.array([run]) ^ mixed(np.array([START]), 50 + k), k)[0]
            keys, place = np.unique(np.append(g[real], run), return_inverse=True)
            self.start.append(int(place[-1]))
            place = place[:-1].astype(np.int32)
            lower, history = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
            lower[place] = self.place[-1]
            ending = np.full(len(h), self.start[-2], np.int32)  # the gram of order k - 1 that ends at each place
            ending[real] = self.place[-1]
            history[place] = ending[real - 1]
            self.keys.append(keys)
            self.place.append(place)
            self.lower.append(lower)
            self.history.append(history)
        for keys, place in zip(self.keys, self.place):
            self.train.append(np.bincount(place[learns], minlength=len(keys)).astype(np.int32))
            held = np.zeros(len(keys), bool)
            held[place[~learns]] = True
            self.held.append(held)


def _requests(row: dict, grams: Grams, k: int, sent: np.ndarray, buckets: int):
    """A chunk's requests for the counts of the grams ``sent`` of order k."""
    at, rows = np.flatnonzero(sent), []
    keys, train, held = grams.keys[k - 1][at], grams.train[k - 1][at], grams.held[k - 1][at]
    for bucket, (i, j) in enumerate(cuts(keys, buckets)):
        if j > i:
            rows.append((k, bucket, row["chunk"], pack(keys[i:j]), pack_few(train[i:j]), pack_bits(held[i:j])))
    return rows


def _merge_counts(t: pa.Table) -> pa.Table:
    """One bucket of one order: each chunk's answer, and what goes into the totals."""
    rows = sorted(t.to_pylist(), key=lambda r: r["chunk"])
    if rows[0]["bucket"] < 0:  # grams that weren't sent, as counts only
        return _table([(rows[0]["kind"], -1, -1, None, None, None, np.sum([r["stats"] for r in rows], axis=0).tolist())])
    parts = [unpack(r["a"]) for r in rows]
    train = np.concatenate([unpack_few(r["b"], len(p)) for r, p in zip(rows, parts)])
    held = np.concatenate([unpack_bits(r["c"], len(p)) for r, p in zip(rows, parts)])
    keys, place = np.unique(np.concatenate(parts), return_inverse=True)
    counts = np.bincount(place, train, len(keys)).astype(np.int64)
    asked = np.zeros(len(keys), bool)
    asked[place[held]] = True
    speaks = np.zeros(len(train), bool)
    has = np.flatnonzero(train)[::-1]
    first = np.full(len(keys), -1, np.int64)
    first[place[has]] = has  # the earliest stays
    speaks[first[first >= 0]] = True
    out, at = [], 0
    for r, p in zip(rows, parts):
        own = slice(at, at + len(p))
        out.append((r["kind"], r["bucket"], r["chunk"], pack_few(counts[place[own]]), pack_bits(speaks[own]), pack_bits(asked[place[own]])))
        at += len(p)
    few = np.bincount(np.minimum(counts, K + 2), minlength=K + 3)[1 : K + 2].tolist()
    out.append((rows[0]["kind"], rows[0]["bucket"], -1, None, None, None, [int(counts.sum()), int((counts > 0).sum()), *few]))
    return _table(out)


class Scored:
    """A chunk's grams with the counts of the whole corpus, up to the order that ``answers`` reach."""

    def __init__(self, row: dict, answers: pa.Table, order: int, reached: int, buckets: int, starts: int, model: Model | None = None):
        self.grams, self.model = Grams(row, order), model
        got = {(k, b): i for i, (k, b) in enumerate(zip(answers["kind"].to_pylist(), answers["bucket"].to_pylist()))}
        self.starts = starts
        self.count, self.speaks, self.asked = [], [], []
        for k in range(1, reached + 1):
            sent, count, speaks, asked = self.known(k)
            at = np.flatnonzero(sent)
            for bucket, (i, j) in enumerate(cuts(self.grams.keys[k - 1][at], buckets)):
                if j > i:
                    a, b, c = (answers[x][got[k, bucket]].as_py() for x in "abc")
                    count[at[i:j]], speaks[at[i:j]], asked[at[i:j]] = unpack_few(a, j - i), unpack_bits(b, j - i), unpack_bits(c, j - i)
            count[self.grams.start[k - 1]], asked[self.grams.start[k - 1]] = starts, True
            self.count.append(count)
            self.speaks.append(speaks)
            self.asked.append(asked)

    def known(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(sent, count, speaks, asked) of the grams of order k: which are sent, and what is known of those that aren't."""
        g = self.grams
        learned, held = g.train[k - 1] > 0, g.held[k - 1].copy()
        if k < 3:
            return np.ones(len(learned), bool), np.zeros(len(learned), np.int64), np.zeros(len(learned), bool), held
        history, lower = g.history[k - 1], g.lower[k - 1]
        least = np.minimum(self.count[k - 2][history], self.count[k - 2][lower])
        both = self.asked[k - 2][history] & self.asked[k - 2][lower]
        sent = np.where(learned, (least >= 2) | both, least >= 1)
        return sent, (learned & ~sent).astype(np.int64), learned & ~sent, held

    def seen(self, k: int) -> np.ndarray:
        """P of each gram of order k that was seen in training, by its own counts."""
        if k == 1:
            return self.model.word(self.count[0])
        of = np.maximum(whole(self.count[k - 2][self.grams.history[k - 1]]), 1.0)
        return self.model.discounted(k, self.count[k - 1]) / of

    def needs(self, k: int) -> np.ndarray:
        """The histories of order k - 1 whose sums a held-out text of this chunk needs, in order."""
        g = self.grams
        history = g.history[k - 1]
        unseen = g.held[k - 1] & (self.count[k - 1] == 0) & (self.count[k - 2][history] > 0)
        return np.unique(history[unseen])


def _merge_sums(t: pa.Table) -> pa.Table:
    """One bucket of the histories of one order: the sums, as asked."""
    rows = sorted(t.to_pylist(), key=lambda r: r["chunk"])
    given = [r for r in rows if r["kind"] < ASKED]
    keys, place = np.unique(np.concatenate([unpack(r["a"]) for r in given]) if given else np.empty(0, np.uint64), return_inverse=True)
    sums = [np.bincount(place, np.concatenate([np.frombuffer(r[x], np.float64) for r in given]), len(keys)) if given else np.empty(0) for x in "bc"]
    out = []
    for r in rows:
        if r["kind"] >= ASKED:
            at = np.searchsorted(keys, unpack(r["a"]))  # each was given by the chunk that speaks for one of its grams
            out.append((r["kind"] - ASKED + SUMMED, r["bucket"], r["chunk"], sums[0][at].tobytes(), sums[1][at].tobytes()))
    return _table(out)


def score(docs: DataFrame, held: str, id_col: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row for each row of ``docs``: id, held_out, n_tokens, n_known, train_tokens, base_score, score, discounts.

    ``held`` is SQL over the columns of ``docs``: true where a text isn't learned from.
    """
    if order < 1:
        raise ValueError("order: 1 or more")
    spark = docs.sparkSession
    table = chunks(docs, f"coalesce({held}, false)", id_col, text)
    sizes = table.select(F.sum(F.expr("aggregate(lens, 0L, (a, x) -> a + x)")), F.sum(F.expr("size(filter(held, x -> not x))"))).first()
    starts = int(sizes[1] or 0)
    total = (sizes[0] or 0) * REQUEST_BYTES
    buckets, tasks = parts_for(total, BUCKET_BYTES), total // TASK_BYTES
    plain = table.select("chunk", "held", "lens", "words", "tokens")

    def first(batches):
        for b in batches:
            for r in range(b.num_rows):
                row = {k: b.column(k)[r].as_py() for k in b.schema.names}
                grams = Grams(row, min(order, 2))
                for k in range(1, min(order, 2) + 1):
                    rows = _requests(row, grams, k, np.ones(len(grams.keys[k - 1]), bool), buckets)
                    for i in range(0, len(rows), 256):
                        yield _messages(rows[i : i + 256])

    def further(k: int):
        def ask(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows:
                return _table([])
            row = left.to_pylist()[0]
            s = Scored(row, right, k, k - 1, buckets, starts)
            sent, count, _, _ = s.known(k)
            once = int(count.sum())
            rows = _requests(row, s.grams, k, sent, buckets)
            return _table([*rows, (k, -1 - row["chunk"] % 64, row["chunk"], None, None, None, [once, once, once, *[0] * K])])

        return ask

    def met(left: DataFrame, right: DataFrame):
        """Both sides by chunk."""
        return spread(left, tasks, "chunk").groupBy("chunk").cogroup(spread(right, tasks, "chunk").groupBy("chunk"))

    def counted(asked: DataFrame) -> DataFrame:
        return stored(spread(asked, tasks, "kind", "bucket").groupBy("kind", "bucket").applyInArrow(_merge_counts, _MESSAGE), "gram-counts")

    tables = [counted(map_arrow(plain, first, _MESSAGE))]
    for k in range(3, order + 1):
        known = reduce(DataFrame.unionAll, tables).where("chunk >= 0")
        tables.append(counted(met(plain, known).applyInArrow(further(k), _MESSAGE)))
    all_ = reduce(DataFrame.unionAll, tables)
    totals = all_.where("chunk < 0").groupBy("kind").agg(*[F.sum(F.col("stats")[i]).alias(f"s{i}") for i in range(K + 3)]).collect()  # a row for each order
    by = {r["kind"]: [int(x or 0) for x in r[1:]] for r in totals}
    each = [by.get(k, [0] * (K + 3)) for k in range(1, order + 1)]
    model = Model(each[0][0], each[0][1], starts, [x[2:] for x in each])

    kind = docs.schema[id_col].dataType.simpleString()
    state = "ids array<{0}>, held array<boolean>, lens array<bigint>, known array<bigint>, base array<double>, part array<double>".format(kind)
    fields = ["ids", "held", "lens", "known", "base", "part"]

    def weigh(left: pa.Table, right: pa.Table) -> pa.Table:
        """Sums for histories, what this chunk needs of them, and its texts' scores without what those will add."""
        types = {f: left.schema.field(f).type for f in ("ids", "held", "lens")} | {"known": pa.list_(pa.int64()), "base": pa.list_(pa.float64()), "part": pa.list_(pa.float64())}
        if not left.num_rows:
            empty = _table([]).drop(["stats"])
            for f in fields:
                empty = empty.append_column(f, pa.array([], types[f]))
            return empty
        row, out = left.to_pylist()[0], []
        s = Scored(row, right, order, order, buckets, starts, model)
        g = s.grams
        needs = [np.empty(0, np.int64)] * 2
        for k in range(2, order + 1):
            history, r, keys = g.history[k - 1], s.count[k - 1], g.keys[k - 2]
            own = np.flatnonzero(s.speaks[k - 1] & s.asked[k - 2][history])
            at, place = np.unique(history[own], return_inverse=True)
            rest = np.bincount(place, r[own] - model.discounted(k, r[own]), len(at))
            lower = np.bincount(place, s.seen(k - 1)[g.lower[k - 1][own]], len(at))
            for bucket, (i, j) in enumerate(cuts(keys[at], buckets)):
                if j > i:
                    out.append((k, bucket, row["chunk"], pack(keys[at[i:j]]), rest[i:j].tobytes(), lower[i:j].tobytes()))
            needs.append(s.needs(k))
            wanted = keys[needs[k]]
            for bucket, (i, j) in enumerate(cuts(wanted, buckets)):
                if j > i:
                    out.append((k + ASKED, bucket, row["chunk"], pack(wanted[i:j])))
        value = np.log10(s.seen(1))
        for k in range(2, order + 1):
            with np.errstate(divide="ignore"):
                value = np.where(s.count[k - 1] > 0, np.log10(s.seen(k)), value[g.lower[k - 1]])
        first_ = np.cumsum(g.lens) - g.lens
        # the backed-off tokens of held-out texts: which text, which history
        texts, which, offset = [], [], np.cumsum([len(x) for x in needs])
        open_ = np.flatnonzero(np.repeat(g.out, g.lens))
        text = np.repeat(np.arange(len(g.lens)), g.lens)
        for k in range(order, 1, -1):
            open_ = open_[s.count[k - 1][g.place[k - 1][open_]] == 0]
            history = g.history[k - 1][g.place[k - 1][open_]]
            was = s.count[k - 2][history] > 0
            texts.append(text[open_[was]])
            which.append(np.searchsorted(needs[k], history[was]) + offset[k] - len(needs[k]))
        seen = np.concatenate([s.count[k - 2][needs[k]] for k in range(2, order + 1)] or [np.empty(0, np.int64)])
        entries = [np.concatenate(x or [np.empty(0, np.int64)]).astype(np.int32).tobytes() for x in (texts, which)]
        out.append((0, -1, row["chunk"], *entries, seen.astype(np.int64).tobytes()))
        tokens = g.place[0]
        own = [row["ids"], row["held"], row["lens"], np.add.reduceat((s.count[0][tokens] > 0).astype(np.int64), first_), np.add.reduceat(model.base(s.count[0])[tokens], first_), np.add.reduceat(value[g.place[-1]], first_)]
        done = _table(out).drop(["stats"])
        for f, x in zip(fields, own):
            done = done.append_column(f, pa.array([None] * (len(out) - 1) + [x], types[f]))
        return done

    weighed = met(table, all_.where("chunk >= 0")).applyInArrow(weigh, f"{_MESSAGE.removesuffix(', stats array<bigint>')}, {state}")
    weighed = stored(weighed, "katz-sums")
    for done in (table, *tables):
        dropped(done)
    summed = weighed.where("kind > 0").select("kind", "bucket", "chunk", "a", "b", "c", F.lit(None).cast("array<bigint>").alias("stats"))
    histories = spread(summed.withColumn("order", F.col("kind") % ASKED), tasks, "order", "bucket").groupBy("order", "bucket").applyInArrow(lambda t: _merge_sums(t.drop(["order"])), _MESSAGE)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        texts, which, c = np.frombuffer(row["a"], np.int32), np.frombuffer(row["b"], np.int32), np.frombuffer(row["c"], np.int64)
        got = sorted(right.select(["kind", "bucket", "a", "b"]).to_pylist(), key=lambda r: (r["kind"], r["bucket"]))
        rest, lower = (np.concatenate([np.frombuffer(r[x], np.float64) for r in got] or [np.empty(0)]) for x in "ab")
        alpha = np.log10((rest + (c > K)) / whole(c)) - np.log10(np.maximum(1.0 - lower, 1e-300))
        n = len(row["lens"])
        score = np.array(row["part"]) + np.bincount(texts, alpha[which], n)
        ids = left["ids"]
        columns = [
            ids.combine_chunks().flatten() if not isinstance(ids, pa.Array) else ids.flatten(),
            pa.array(row["held"], pa.bool_()), pa.array(row["lens"], pa.int64()), pa.array(row["known"], pa.int64()), pa.array(np.full(n, model.total, np.int64)), pa.array(row["base"], pa.float64()), pa.array(score), pa.array([model.how] * n),
        ]
        return pa.table(columns, names=["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "discounts"])

    result = f"id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double, discounts string"
    return met(weighed.where("kind = 0").select("chunk", "a", "b", "c", *fields), histories).applyInArrow(finish, result)


HELD_OUT = "pmod(crc32(cast(cast({id} as string) as binary)), 7) = 2"


def op7_katz_scoring(docs: DataFrame) -> DataFrame:
    return score(docs, HELD_OUT.format(id="doc_id")).withColumnRenamed("id", "doc_id")
