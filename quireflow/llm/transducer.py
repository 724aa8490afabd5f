"""Byte-level BPE by a lazily determinised transducer, and streaming decoding.

A token sequence is the encoding of its bytes if and only if each two neighbours are the encoding of theirs, so
the encoding of a prefix ends in one certain token that fits the one before it. Hence merges make a finite-state
transducer: a hypothesis is a token that fits the last one chosen, read in part (a node of the trie of token bytes). ``Transducer``
determinises it while it reads: a state is the set of hypotheses alive, each with the tokens it hasn't
given out yet. What all agree on is given out, so a token leaves after a bounded lookahead; only the table of
states seen is kept, and it starts anew when it is full. A word of any length takes one step for each byte.

The pattern splits a text first. No match reaches from a character to white space after it, so texts are cut
there into pieces (a run with the space before it, or white space), and ids of recent pieces are remembered
in two generations of bounded size. Character classes are read off the tiktoken library, so versions of Unicode can't differ.

Decoding joins the bytes of tokens block by block; ``Utf8Stream`` is a state machine that holds back a
character whose bytes haven't all come.

Defined results: a null text is empty; an empty text has no ids and decodes to nothing. Rows are handled each
for itself, so repeated rows, null ids and other columns change nothing.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .bpe import LONGEST_KEPT, kept
from .common import map_arrow, tokenizer_path

#: States of a transducer before it starts anew, and pairs of tokens whose fit is remembered.
STATES, PAIRS = 300_000, 400_000
#: Pieces that are resolved together.
PIECES = 50_000
#: Pieces in a generation of the memory of a Python worker.
REMEMBERED = 150_000
#: Characters of a text that are split at once, and ids that are decoded at once.
SLICE, BLOCK = 1 << 21, 1 << 16
NEVER = 1 << 60
FULL = range(0x110000)


class Ranks:
    """A rank file as a trie of token bytes: ``step`` from node and byte, ``token`` of a node or -1, ``inner`` where it goes on."""

    def __init__(self, raw: bytes):
        pairs = [line.split() for line in raw.splitlines() if line.strip()]
        self.rank = {base64.b64decode(a): int(b) for a, b in pairs}
        self.tokens: dict[int, bytes] = {i: t for t, i in self.rank.items()}
        if len(self.tokens) < len(self.rank) or any(bytes([b]) not in self.rank for b in range(256)):
            raise ValueError("a rank file must have every byte, and each rank once")
        self.step: dict[int, int] = {}
        self.token, self.inner = [-1], [True]
        for t, i in self.rank.items():
            node = 0
            for b in t:
                self.inner[node] = True
                at = self.step.get(node << 8 | b)
                if at is None:
                    at = self.step[node << 8 | b] = len(self.token)
                    self.token.append(-1)
                    self.inner.append(False)
                node = at
            self.token[node] = i
        self._fits: dict[int, bool] = {}

    def merge(self, word: bytes) -> list[bytes]:
        """The parts of a short word: the pair of lowest rank merges first, leftmost first."""
        parts = [word[i : i + 1] for i in range(len(word))]
        rank = self.rank.get
        pairs = [rank(a + b, NEVER) for a, b in zip(parts, parts[1:])]
        while pairs and (best := min(pairs)) < NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NEVER)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NEVER)
        return parts

    def fits(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: come first): the two are the encoding of their bytes."""
        key = before << 20 | token
        known = self._fits.get(key)
        if known is None:
            two = [self.tokens[i] for i in (before, token) if i >= 0]
            known = self.merge(b"".join(two)) == two
            if len(self._fits) >= PAIRS:
                self._fits.clear()
            self._fits[key] = known
        return known


class Transitions:
    """A growing hash table in numpy: (state, byte) to the next state and the number of what is given out."""

    def __init__(self, bits: int = 16):
        self.bits, self.count = bits, 0
        self.keys = np.full(1 << bits, -1, np.int64)
        self.to, self.out = np.zeros(1 << bits, np.int32), np.zeros(1 << bits, np.int32)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The slot of each key, -1 for those that aren't there."""
        slot, mask = self._slot(keys), (1 << self.bits) - 1
        here = self.keys[slot]
        out = np.where(here == keys, slot, -1)
        left = np.flatnonzero((here != keys) & (here != -1))
        while len(left):
            slot[left] = (slot[left] + 1) & mask
            here = self.keys[slot[left]]
            hit = here == keys[left]
            out[left[hit]] = slot[left[hit]]
            left = left[~hit & (here != -1)]
        return out

    def put(self, key: int, to: int, out: int) -> None:
        if 2 * self.count >= 1 << self.bits:
            old = self.keys, self.to, self.out
            self.__init__(self.bits + 1)
            for k, t, o in zip(*[a[old[0] >= 0].tolist() for a in old]):
                self.put(k, t, o)
        slot, mask = (key * 0x9E3779B97F4A7C15 % (1 << 64)) >> (64 - self.bits), (1 << self.bits) - 1
        while self.keys[slot] != -1:
            slot = (slot + 1) & mask
        self.keys[slot], self.to[slot], self.out[slot] = key, to, out
        self.count += 1


class Numbers:
    """An array that grows."""

    def __init__(self):
        self.kept, self.n = np.zeros(1024, np.int64), 0

    def append(self, x: int) -> None:
        if self.n == len(self.kept):
            self.kept = np.concatenate([self.kept, np.zeros(self.n, np.int64)])
        self.kept[self.n] = x
        self.n += 1

    def all(self) -> np.ndarray:
        return self.kept[: self.n]


class Transducer:
    """``encode`` gives the ids of matches of the pattern; all words of a call take a step at a time.

    A state is a tuple of hypotheses: (ids not given out yet, last id, node of the trie). The last one has no token begun.
    """

    START = (((), -1, 0),)

    def __init__(self, ranks: Ranks, most: int = STATES):
        self.ranks, self.most = ranks, most
        self.steps = 0  # transitions determined so far
        self.lookahead = 0  # the most tokens that a state has held back
        self.clear()

    def clear(self) -> None:
        self.table = Transitions()
        self.number: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.rests = Numbers()  # of each state: what a word that ends there still gives out
        self.given: dict[tuple[int, ...], int] = {}  # tuples of ids, numbered
        self.flat, self.firsts, self.counts = Numbers(), Numbers(), Numbers()  # the ids of these, with the place and number of each's
        self._numbered(())
        self.state(self.START)

    def _numbered(self, ids: tuple[int, ...]) -> int:
        at = self.given.get(ids)
        if at is None:
            at = self.given[ids] = len(self.given)
            self.firsts.append(self.flat.n)
            self.counts.append(len(ids))
            for i in ids:
                self.flat.append(i)
        return at

    def state(self, hypotheses: tuple) -> int:
        at = self.number.get(hypotheses)
        if at is None:
            at = self.number[hypotheses] = len(self.states)
            self.states.append(hypotheses)
            self.rests.append(self._numbered(hypotheses[-1][0]))
            self.lookahead = max(self.lookahead, max([len(h[0]) for h in hypotheses]))
        return at

    def advance(self, at: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Determine the transition of a state: the next state, and the ids that all its hypotheses agree on."""
        step, token_of, inner, fits = self.ranks.step, self.ranks.token, self.ranks.inner, self.ranks.fits
        alive, whole = [], None
        for rest, last, node in self.states[at]:
            to = step.get(node << 8 | byte)
            if to is None:
                continue
            token = token_of[to]
            if whole is None and token >= 0 and fits(last, token):
                whole = ((*rest, token), token, 0)
            if inner[to]:
                alive.append((rest, last, to))
        alive.append(whole)
        low, n = min(alive)[0], 0
        if low:
            high = max(alive)[0]
            while n < len(low) and low[n] == high[n]:
                n += 1
        self.steps += 1
        return self.state(tuple([(rest[n:], last, node) for rest, last, node in alive]) if n else tuple(alive)), low[:n]

    def encode_long(self, word: bytes) -> bytes:
        """The ids of one word of any length; when the table is full, it starts anew from the state under way."""
        at, out, known = self.state(self.START), [], {}
        for byte in word:
            hit = known.get(at << 8 | byte)
            if hit is None:
                if len(self.states) >= self.most:
                    now = self.states[at]
                    self.clear()
                    known.clear()
                    at = self.state(now)
                hit = known[at << 8 | byte] = self.advance(at, byte)
            at = hit[0]
            out += hit[1]
        out += self.states[at][-1][0]
        return np.array(out, "<u4").tobytes()

    def _walked(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, end of each word's ids in them); long words give none."""
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        start = np.cumsum(size) - size
        alive = np.flatnonzero((size > 0) & (size <= LONGEST_KEPT))
        state = np.zeros(len(alive), np.int64)
        owners, numbers, done, ends = [], [], [], []
        k = 0
        while len(alive):
            key = state << 8 | text[start[alive] + k]
            at = self.table.find(key)
            new = np.unique(key[at < 0])
            if len(new):
                for x in new.tolist():
                    to, ids = self.advance(x >> 8, x & 255)
                    self.table.put(x, to, self._numbered(ids))
                at = self.table.find(key)
            given = self.table.out[at]
            some = np.flatnonzero(given)
            owners.append(alive[some])
            numbers.append(given[some])
            state, k = self.table.to[at].astype(np.int64), k + 1
            last = size[alive] == k
            done.append(alive[last])
            ends.append(state[last])
            alive, state = alive[~last], state[~last]
        if not done:
            return np.empty(0, "<u4"), np.zeros(len(words), np.int64)
        owner = np.concatenate(owners + done)  # what the words hold back at their ends comes last
        rest = self.rests.all()[np.concatenate(ends)]
        order = np.argsort(owner, kind="stable")
        number = np.concatenate([*numbers, rest])[order]
        count = self.counts.all()[number]
        end = np.cumsum(count)
        ids = self.flat.all().astype("<u4")[np.repeat(self.firsts.all()[number] - (end - count), count) + np.arange(end[-1])]
        return ids, np.cumsum(np.bincount(owner[order], count, len(words)).astype(np.int64))

    def encode(self, words: list[bytes], ends: list[int] | None = None) -> list[bytes]:
        """The ids of each word, or of the words up to each of ``ends``, as little-endian unsigned 32-bit integers."""
        if len(self.states) >= self.most:
            self.clear()
        ends = list(range(1, len(words) + 1)) if ends is None else ends
        ids, to = self._walked(words)
        raw, to = ids.tobytes(), [0, *(4 * to).tolist()]
        cuts = [to[e] for e in ends]
        out = [raw[i:j] for i, j in zip([0, *cuts], cuts)]
        if any(len(w) > LONGEST_KEPT for w in words):
            for k, (i, j) in enumerate(zip([0, *ends], ends)):
                if any(len(w) > LONGEST_KEPT for w in words[i:j]):
                    out[k] = b"".join([self.encode_long(words[m]) if len(words[m]) > LONGEST_KEPT else raw[to[m] : to[m + 1]] for m in range(i, j)])
        return out


@lru_cache(1)
def character_codes() -> bytes:
    """For each code point what the tiktoken library takes it for: letter, number, white space or other."""
    import tiktoken

    every = "".join(chr(i) for i in FULL if not 0xD800 <= i <= 0xDFFF)
    codes = bytearray(b"!" * len(FULL))
    for pattern, code in ((r"\p{L}", "A"), (r"\p{N}", "0"), (r"\s", "\t")):
        found = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks={bytes([b]): b for b in range(256)}, special_tokens={})
        for c in set(bytes(found.encode_ordinary(every)).decode()):
            codes[ord(c)] = ord(code)
    return bytes(codes)


class Folded(dict):
    """For ``str.translate``: ASCII stays as it is, others become a character of their class."""

    def __init__(self, codes: bytes):
        super().__init__()
        self.codes = codes

    def __missing__(self, c: int) -> int:
        self[c] = found = c if c < 128 else self.codes[c]
        return found


class Splitter:
    """Matches of the pattern, by way of pieces."""

    #: fixed value: the pattern with its classes written for folded characters
    WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")

    def __init__(self, codes: bytes):
        self.folded = Folded(codes)
        space = "".join(f"\\U{i:08x}" for i, c in enumerate(codes) if c == 9)
        self.piece = re.compile(f" ?[^{space}]+|[{space}]+(?![^{space}])|[{space}]+")
        self.edge = re.compile(f"(?<=[^{space}])[{space}]")

    def slices(self, text: str) -> Iterator[str]:
        """A long text in parts that end before white space: no match reaches over their edges."""
        at = 0
        while len(text) - at > SLICE:
            edge = self.edge.search(text, at + SLICE)
            if not edge:
                break
            yield text[at : edge.start()]
            at = edge.start()
        yield text[at:] if at else text

    def matches(self, pieces: list[str]) -> tuple[list[bytes], list[int]]:
        """The matches in all pieces, and where those of each piece end."""
        words: list[bytes] = []
        ends: list[int] = []
        if not pieces:
            return words, ends
        blank = {i: p for i, p in enumerate(pieces) if p.isspace()}  # a match each
        text = "\n".join([p for p in pieces if not p.isspace()] if blank else pieces)  # a line end is a match between others
        found = self.WORD.findall(text if text.isascii() else text.translate(self.folded))
        if not text.isascii():
            to = np.cumsum(np.fromiter(map(len, found), np.int64, len(found))).tolist()
            found = [text[i:j] for i, j in zip([0, *to], to)]

        def blanks() -> None:
            while len(ends) in blank:
                words.append(blank[len(ends)].encode())
                ends.append(len(words))

        if blank:
            blanks()
        for w in found:
            if w == "\n":
                ends.append(len(words))
                if blank:
                    blanks()
            else:
                words.append(w.encode())
        if text:
            ends.append(len(words))
            blanks()
        return words, ends


class Encoder:
    """ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, raw: bytes, codes: bytes):
        self.ranks = Ranks(raw)
        self.transducer, self.split = Transducer(self.ranks), Splitter(codes)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def resolve(self, pieces: list[str]) -> dict[str, bytes]:
        """The ids of distinct pieces, read off the transducer."""
        out: dict[str, bytes] = {}
        for i in range(0, len(pieces), PIECES):
            some = pieces[i : i + PIECES]
            out |= zip(some, self.transducer.encode(*self.split.matches(some)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text; texts are taken together until they have ``SLICE`` characters."""
        out, group, size = [], [], 0
        for t in texts:
            if len(t) > SLICE:
                out += self._encode(group)
                out.append(b"".join([self._encode([part])[0] for part in self.split.slices(t)]))
                group, size = [], 0
                continue
            group.append(t)
            size += len(t)
            if size > SLICE:
                out += self._encode(group)
                group, size = [], 0
        return out + self._encode(group)

    def _encode(self, texts: list[str]) -> list[bytes]:
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        pieces = list(map(self.split.piece.findall, texts))
        found = [list(map(self.young.get, p)) for p in pieces]
        missing = {p for ps, fs in zip(pieces, found) if None in fs for p, f in zip(ps, fs) if f is None}
        new = {p: f for p in missing if (f := self.old.get(p)) is not None}
        new |= self.resolve([p for p in missing if p not in new])
        self.young.update((p, f) for p, f in new.items() if len(p) <= LONGEST_KEPT)
        get = new.get
        return [b"".join([get(p) if f is None else f for p, f in zip(ps, fs)] if None in fs else fs) for ps, fs in zip(pieces, found)]


def _utf8_machine() -> list[list[int]]:
    """State and byte to state: 0 is between characters, 8 is an error, the others wait for bytes.

    1 to 3 wait for so many bytes of any kind that continue; 4 to 7 wait for the second byte after E0, ED, F0
    and F4, which have fewer (no overlong forms, surrogates or numbers over U+10FFFF).
    """
    follow = range(0x80, 0xC0)
    rows = [[8] * 256 for _ in range(9)]
    leads = {0: range(0x80), 1: range(0xC2, 0xE0), 2: range(0xE1, 0xF0), 3: range(0xF1, 0xF4)}
    for to, some in leads.items():
        for b in some:
            rows[0][b] = to
    for lead, state in ((0xE0, 4), (0xED, 5), (0xF0, 6), (0xF4, 7)):
        rows[0][lead] = state
    for state, some, to in ((1, follow, 0), (2, follow, 1), (3, follow, 2), (4, follow[0x20:], 1), (5, follow[:0x20], 1), (6, follow[0x10:], 2), (7, follow[:0x10], 2)):
        for b in some:
            rows[state][b] = to
    return rows


class Utf8Stream:
    """Text of bytes that come in parts; what can't be a character becomes U+FFFD, as in one decoding of the whole."""

    MACHINE = _utf8_machine()

    def __init__(self):
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        self.held = b""
        for back in range(1, min(3, len(data)) + 1):  # the last byte that may begin a character
            if not 0x80 <= data[-back] < 0xC0:
                state = 0
                for b in data[-back:]:
                    state = self.MACHINE[state][b]
                if 0 < state < 8:
                    self.held, data = data[-back:], data[:-back]
                break
        return data.decode("utf-8", "replace")

    def finish(self) -> str:
        out, self.held = self.held.decode("utf-8", "replace"), b""
        return out


def decoded_parts(ids: Iterable[list[int]], tokens: dict[int, bytes]) -> Iterator[tuple[bytes, str]]:
    """(bytes, text) of blocks of ids; a character that two blocks share comes with the later one."""
    stream = Utf8Stream()
    for block in ids:
        data = b"".join([tokens[i] for i in block])
        yield data, stream.feed(data)
    yield b"", stream.finish()


def encoded(docs: DataFrame, path: str | None = None, id_col: str = "doc_id", text: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens, n_chars (of the decoded text), ids_sha256, decoded_sha256, and as asked for ids (binary) and decoded."""
    sc = docs.sparkSession.sparkContext
    with open(path or tokenizer_path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        shared = sc.broadcast((f.read(), character_codes()))  # the file's size and 1 MB
    names = ["id", "n_tokens", "n_chars", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_text]
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, n_chars bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids + ", decoded string" * with_text
    types = [None, pa.int64(), pa.int64(), pa.string(), pa.string(), *[pa.binary()] * with_ids, *[pa.string()] * with_text]

    def run(batches):
        raw, codes = shared.value
        encoder = kept(("transducer", hashlib.sha256(raw).hexdigest()), lambda: Encoder(raw, codes))
        tokens = encoder.ranks.tokens
        names_of = {i: str(i) for i in tokens}
        for b in batches:
            rows = []
            for ids in encoder.encode([t or "" for t in b.column(1).to_pylist()]):
                view, own, whole = memoryview(ids).cast("I"), hashlib.sha256(), hashlib.sha256()
                n_chars, texts = 0, []
                blocks = [range(i, min(i + BLOCK, len(view))) for i in range(0, len(view), BLOCK)]
                for i, block in enumerate(blocks):
                    own.update((("," if i else "") + ",".join([names_of[k] for k in view[block.start : block.stop]])).encode())
                for data, part in decoded_parts((view[k.start : k.stop] for k in blocks), tokens):
                    whole.update(data)
                    n_chars += len(part)
                    if with_text:
                        texts.append(part)
                rows.append((len(view), n_chars, own.hexdigest(), whole.hexdigest(), *[ids] * with_ids, *["".join(texts)] * with_text))
            columns = list(zip(*rows)) if rows else [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, k) for c, k in zip(columns, types[1:])]], names=names)

    return map_arrow(docs.select(id_col, text), run, schema)


def op12_byte_bpe_transducer(docs: DataFrame) -> DataFrame:
    return encoded(docs).withColumnRenamed("id", "doc_id")
