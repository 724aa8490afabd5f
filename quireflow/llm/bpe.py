"""BPE encoding with a minimal acyclic transducer over frequent words, and decoding.

``count_words`` counts the pre-tokens of the whole corpus; the ``LEXICON_WORDS`` most frequent are
merged once on the driver and compiled into a minimal acyclic automaton (states with the same
suffixes are one). Every edge carries how many words come before those behind it, so the sum along a
word's path is its number, which gives its ids. The compiled file goes to the executors with
``SparkContext.addFile`` from the shared folder and is memory-mapped by all their Python workers. Words outside it are merged
exactly, by rank, leftmost first.

Splitting follows the tokenizer file: strings of its special tokens are found first, then come
normalisation and pre-tokens. A file that splits or merges in another way is refused. No pre-token reaches over space or U+0009 to U+000D, so texts are handled
by the runs between these, and ids of recent runs are remembered (two generations of bounded size). Runs
of printable ASCII and Latin-1 letters are split here; any other run is normalised and split by the library.

Defined results: a null text is empty; an empty text has no ids and decodes to the empty string. Rows
are handled each for itself, so repeated rows, null ids and other columns change nothing.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import dropped, map_arrow, put_file, stored, tokenizer_path

#: Words in the lexicon: bounds the driver's work and the compiled file (some MB).
LEXICON_WORDS = 1 << 17
#: A word longer than this isn't put into the lexicon.
LONGEST = 48
#: Runs in a generation of the memory of a Python worker, and the bytes of the longest one kept.
REMEMBERED, LONGEST_KEPT = 120_000, 64
#: Entries of a task's word counter before it sends what it has.
COUNTED = 500_000
#: Ids are under 2^20; a number that no rank reaches stands for a pair that never merges.
ID_BITS, ID_MASK, NONE = 20, (1 << 20) - 1, 1 << 62


def byte_chars() -> list[str]:
    """The character that byte-level vocabularies use for each byte: itself if printable, else the next from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out, spare = [""] * 256, 0
    for b in range(256):
        if b in plain:
            out[b] = chr(b)
        else:
            out[b], spare = chr(0x100 + spare), spare + 1
    return out


#: fixed values: what a tokenizer file must say for ``Splitter`` and ``Vocabulary`` to give the library's ids
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
WORD_PATTERN = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
PLAIN_MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "end_of_word_suffix": "</w>", "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}


def check_spec(spec: dict) -> None:
    """Refuse a tokenizer file whose splitting or merging isn't the one that is written out here: ids would be wrong."""
    wrong = [k for k, v in (("normalizer", NORMALIZER), ("pre_tokenizer", PRE_TOKENIZER), ("decoder", None)) if spec.get(k) != v]
    wrong += [f"model.{k}" for k, v in PLAIN_MODEL.items() if spec["model"].get(k) != v]
    for t in spec.get("added_tokens") or []:
        if t.get("single_word") or t.get("lstrip") or t.get("rstrip") or t.get("normalized") or not t["content"].startswith("<|") or re.search("\\s", t["content"]):
            wrong.append(f"added token {t['content']!r}")
    if wrong:
        raise ValueError(f"this tokenizer file can't be used here, other than supported: {', '.join(wrong)}")


class Vocabulary:
    """What the tokenizer file says, ready for merging: made on the driver, broadcast (its size is the file's)."""

    def __init__(self, text: str):
        self.text = text
        spec = json.loads(text)
        check_spec(spec)
        model = spec["model"]
        vocab, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.end = end
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens") or []}
        self.tokens = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for t, i in [*vocab.items(), *self.special.items()]:
            self.tokens[i] = t
        chars = byte_chars()
        self.inner = [vocab.get(c, -1) for c in chars]
        self.last = [vocab.get(c + end, -1) for c in chars]
        self.byte = {c: b for b, c in enumerate(chars)}
        # a pair of ids as one number, to (rank, merged id) as one number
        self.merges: dict[int, int] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault(vocab[a] << ID_BITS | vocab[b], rank << ID_BITS | vocab[a + b])

    def merge(self, word: bytes) -> list[int]:
        """The ids of one pre-token: the pair of lowest rank merges first, leftmost first."""
        inner = self.inner
        ids = [inner[b] for b in word[:-1]] + [self.last[word[-1]]]
        n = len(ids)
        if n > 64:
            return self._merge_long(ids)
        get = self.merges.get
        pairs = [get(a << ID_BITS | b, NONE) for a, b in zip(ids, ids[1:])]
        while pairs and (best := min(pairs)) != NONE:
            i = pairs.index(best)
            ids[i : i + 2] = [best & ID_MASK]
            del pairs[i]
            if i < len(pairs):
                pairs[i] = get(ids[i] << ID_BITS | ids[i + 1], NONE)
            if i:
                pairs[i - 1] = get(ids[i - 1] << ID_BITS | ids[i], NONE)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over a linked list: n log n for words of any length."""
        n = len(ids)
        after, before = [*range(1, n), -1], [-1, *range(n - 1)]
        get = self.merges.get
        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := get(ids[i] << ID_BITS | ids[i + 1]))]
        heapq.heapify(heap)
        while heap:
            best, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j < 0 or ids[j] != b:
                continue
            ids[i], ids[j] = best & ID_MASK, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else -1
                if right >= 0 and (m := get(ids[left] << ID_BITS | ids[right])):
                    heapq.heappush(heap, (m, left, ids[left], ids[right]))
        out, i = [], 0
        while i >= 0:
            out.append(ids[i])
            i = after[i]
        return out


class Merger:
    """``Vocabulary.merge`` for many words at once: each round merges the best pair of every word that has one.

    The merges are an open-addressed hash table; a pair's rank and result are one number, so the least
    is the pair of lowest rank, and the first of equals is the leftmost.
    """

    NONE = np.uint64(1 << 63)

    def __init__(self, vocabulary: Vocabulary):
        pairs = np.fromiter(vocabulary.merges.keys(), np.uint64, len(vocabulary.merges))
        values = np.fromiter(vocabulary.merges.values(), np.uint64, len(vocabulary.merges))
        self.bits = max(4, (4 * len(pairs)).bit_length())
        self.keys = np.full(1 << self.bits, self.NONE)
        self.values = np.full(1 << self.bits, self.NONE)
        left = np.arange(len(pairs))
        slot = self._slot(pairs)
        while len(left):  # the first at each free slot stays, the others go on to the next
            free = self.keys[slot] == self.NONE
            _, first = np.unique(np.where(free, slot, np.arange(len(slot)) + (1 << self.bits)), return_index=True)
            stay = np.zeros(len(left), bool)
            stay[first] = True
            stay &= free
            self.keys[slot[stay]] = pairs[left[stay]]
            self.values[slot[stay]] = values[left[stay]]
            left, slot = left[~stay], (slot[~stay] + 1) & ((1 << self.bits) - 1)
        self.inner, self.last = np.array(vocabulary.inner, np.int64), np.array(vocabulary.last, np.int64)

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return (pairs * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - self.bits)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        pairs = a.astype(np.uint64) << np.uint64(ID_BITS) | b.astype(np.uint64)
        out = np.full(len(pairs), self.NONE)
        left, slot = np.arange(len(pairs)), self._slot(pairs)
        while len(left):
            here = self.keys[slot]
            hit = here == pairs[left]
            out[left[hit]] = self.values[slot[hit]]
            on = ~hit & (here != self.NONE)
            left, slot = left[on], (slot[on] + 1) & ((1 << self.bits) - 1)
        return out

    def __call__(self, words: list[bytes]) -> list[bytes]:
        out: list[bytes] = [b""] * len(words)
        if not words:
            return out
        size = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8)
        end = np.cumsum(size)
        ids = self.inner[text]
        ids[end - 1] = self.last[text[end - 1]]
        word = np.arange(len(words))
        rank = np.full(len(ids), self.NONE)  # of each id with the one after it
        inside = np.ones(len(ids), bool)
        inside[end - 1] = False
        at = np.flatnonzero(inside)
        rank[at] = self._find(ids[at], ids[at + 1])
        while len(word):
            first = end - size
            best = np.minimum.reduceat(rank, first)
            going = best != self.NONE
            if not going.all():  # finished words leave
                raw, b = ids.astype("<u4").tobytes(), (4 * first).tolist()
                e = (4 * end).tolist()
                for i in np.flatnonzero(~going).tolist():
                    out[word[i]] = raw[b[i] : e[i]]
                stays = np.repeat(going, size)
                ids, rank = ids[stays], rank[stays]
                word, size, best = word[going], size[going], best[going]
                if not len(word):
                    break
                end = np.cumsum(size)
                first = end - size
            hits = np.flatnonzero(rank == np.repeat(best, size))
            owner = np.searchsorted(end, hits, side="right")
            hits = hits[np.concatenate([[True], owner[1:] != owner[:-1]])]  # the leftmost of each word
            ids[hits] = (best & np.uint64(ID_MASK)).astype(np.int64)
            keep = np.ones(len(ids), bool)
            keep[hits + 1] = False
            hits -= np.arange(len(hits))  # one id before each went
            ids, rank = ids[keep], rank[keep]
            size = size - 1
            end = np.cumsum(size)
            final = hits == end - 1
            rank[hits[final]] = self.NONE
            a = hits[~final]
            rank[a] = self._find(ids[a], ids[a + 1])
            b = hits[hits > end - size] - 1
            rank[b] = self._find(ids[b], ids[b + 1])
        return out


class Splitter:
    """Pre-tokens of a run of characters without white space, as bytes; special tokens as their id."""

    #: Printable ASCII and the letters U+00C0 to U+00FF: normalisation changes only their case.
    PLAIN = re.compile("[\x21-\x7e\xc0-\xd6\xd8-\xf6\xf8-\xff]+")
    WORD = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\xdf-\xf6\xf8-\xff]+|[0-9]|[^a-z0-9\xdf-\xf6\xf8-\xff]+")

    def __init__(self, vocabulary: Vocabulary):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(vocabulary.text)
        self.byte = vocabulary.byte
        self.special = vocabulary.special
        names = sorted(map(re.escape, self.special), key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(names) + ")") if names else None

    def __call__(self, text: str) -> list[bytes | int]:
        if self.PLAIN.fullmatch(text) and "<|" not in text:
            return [w.encode() for w in self.WORD.findall(text.lower())]
        out: list[bytes | int] = []
        for piece in self.cut.split(text) if self.cut else [text]:
            if piece in self.special:
                out.append(self.special[piece])
            elif piece:
                split = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(piece))
                out += [bytes(self.byte[c] for c in s) for s, _ in split if s]
        return out


class Lexicon:
    """The automaton: edges sorted by (state, byte), each with its target and the words before it; state 0 is the start."""

    PARTS = (("edges", np.uint32), ("targets", np.uint32), ("before", np.uint32), ("final", np.uint8), ("offsets", np.uint32), ("ids", np.uint32))

    @staticmethod
    def compile(words: Iterable[bytes], merge) -> bytes:
        """Build from sorted distinct words, minimising as it goes: a finished state equal to a known one is that one."""
        known: dict[tuple, int] = {}
        kept: list[tuple[bool, tuple[tuple[int, int], ...]]] = [(False, ())]  # 0 is kept for the start
        counts = [0]
        path: list[list] = [[False, []]]
        last = b""
        ids: list[int] = []
        offsets = [0]

        def finish(node: list) -> int:
            key = (node[0], tuple(node[1]))
            if key not in known:
                known[key] = len(kept)
                kept.append(key)
                counts.append(node[0] + sum(counts[t] for _, t in node[1]))
            return known[key]

        def close(depth: int) -> None:
            while len(path) > depth + 1:
                node = path.pop()
                path[-1][1].append((last[len(path) - 1], finish(node)))

        for word in words:
            same = 0
            while same < min(len(word), len(last)) and word[same] == last[same]:
                same += 1
            close(same)
            path += [[False, []] for _ in range(len(word) - same)]
            path[-1][0] = True
            last = word
            ids += merge(word)
            offsets.append(len(ids))
        close(0)
        kept[0] = (path[0][0], tuple(path[0][1]))
        edges, targets, before = [], [], []
        for state, (final, out) in enumerate(kept):
            seen = int(final)
            for b, t in out:
                edges.append(state << 8 | b)
                targets.append(t)
                before.append(seen)
                seen += counts[t]
        parts = [edges, targets, before, [f for f, _ in kept], offsets, ids]
        arrays = [np.array(p, dtype=t) for p, (_, t) in zip(parts, Lexicon.PARTS)]
        head = np.array([a.nbytes for a in arrays], dtype=np.uint64).tobytes()
        return head + b"".join(a.tobytes() + bytes(-a.nbytes % 8) for a in arrays)

    def __init__(self, buffer):
        sizes = np.frombuffer(buffer, np.uint64, len(self.PARTS)).tolist()
        at = 8 * len(self.PARTS)
        for (name, kind), n in zip(self.PARTS, sizes):
            setattr(self, name, np.frombuffer(buffer, kind, int(n) // np.dtype(kind).itemsize, at))
            at += int(n) + (-int(n) % 8)

    @classmethod
    def open(cls, path: str) -> Lexicon:
        with open(path, "rb") as f:
            return cls(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))

    def numbers(self, words: list[bytes]) -> np.ndarray:
        """The number of each word, -1 for words that aren't in it; all words take a step at a time."""
        n = len(words)
        length = np.fromiter(map(len, words), np.int64, n)
        out = np.full(n, -1, np.int64)
        if not n or not len(self.edges):
            return out
        alive = np.flatnonzero((length > 0) & (length <= LONGEST))
        start = np.cumsum(length) - length
        text = np.frombuffer(b"".join(words), np.uint8)
        state, number, step = np.zeros(len(alive), np.uint32), np.zeros(len(alive), np.int64), 0
        while len(alive):
            key = state << np.uint32(8) | text[start[alive] + step]
            at = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            ok = self.edges[at] == key
            alive, at, number = alive[ok], at[ok], number[ok]
            state, number, step = self.targets[at], number + self.before[at], step + 1
            done = length[alive] == step
            ended = done & (self.final[state] == 1)
            out[alive[ended]] = number[ended]
            alive, state, number = alive[~done], state[~done], number[~done]
        return out


_KEPT: dict[object, object] = {}


def kept(key: object, make):
    """One object for all tasks of a Python worker, such as an encoder with its memory; a few at most are kept."""
    if key not in _KEPT:
        if len(_KEPT) >= 3:
            _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def runs_of(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """The runs of each text between white space: (offsets of the texts' runs, runs). ASCII runs are lower-cased.

    Others keep their case: normalisation composes letters and marks first, and some compose only in
    lower case. So do runs with a string that may be a special token, as those are found before
    normalisation. Empty runs stand for no characters.
    """
    lists = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
    runs = lists.flatten().dictionary_encode()
    names = runs.dictionary
    lower = pc.and_(pc.string_is_ascii(names), pc.invert(pc.match_substring(names, "<|")))
    merged = pc.if_else(lower, pc.ascii_lower(names), names).dictionary_encode()
    return lists.offsets.to_numpy(), pa.DictionaryArray.from_arrays(merged.indices.take(runs.indices), merged.dictionary)


class RunMemory:
    """Encodes texts run by run, and remembers the ids of recent runs in two generations of bounded size."""

    def __init__(self):
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def resolve(self, runs: list[str]) -> list[bytes]:
        """The ids of each run, as little-endian unsigned 32-bit integers."""
        raise NotImplementedError

    def recall(self, runs: list[str]) -> list[bytes]:
        """The ids of distinct runs, from memory or else resolved."""
        found = list(map(self.young.get, runs))
        missing = [i for i, v in enumerate(found) if v is None]
        unknown = []
        for i in missing:
            v = self.old.get(runs[i])
            if v is None:
                unknown.append(i)
            else:
                found[i] = self.young[runs[i]] = v
        for i, v in zip(unknown, self.resolve([runs[i] for i in unknown])):
            found[i] = v
            if len(runs[i]) <= LONGEST_KEPT:
                self.young[runs[i]] = v
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {}
        return found

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, end of each text's ids in them). Null is an empty text."""
        at, runs = runs_of(texts)
        ids = self.recall(runs.dictionary.to_pylist())
        size = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
        flat = np.frombuffer(b"".join(ids), "<u4")
        first = np.cumsum(size) - size
        which = runs.indices.to_numpy()
        n = size[which]
        end = np.concatenate([np.zeros(1, np.int64), np.cumsum(n)])
        place = np.repeat(first[which] - end[:-1], n)
        place += np.arange(len(place))
        return flat[place], end[at[1:]]

    def encode_each(self, texts: pa.Array) -> list[np.ndarray]:
        flat, ends = self.encode(texts)
        return np.split(flat, ends[:-1]) if len(ends) else []


class LibraryEncoder(RunMemory):
    """ids of runs by the tokenizers library itself.

    The library is given each new word (letters, a number or signs) of a run once; recent words are remembered.
    """

    def __init__(self, text: str):
        super().__init__()
        vocabulary = Vocabulary(text)
        self.split = Splitter(vocabulary)
        self.library = self.split.library
        self.ends = np.array([bool(vocabulary.end) and t.endswith(vocabulary.end) for t in vocabulary.tokens])
        self.words: dict[bytes, bytes] = {}

    def resolve(self, runs: list[str]) -> list[bytes]:
        pieces = [self.split(r) for r in runs]
        if len(self.words) > REMEMBERED // 3:
            self.words.clear()
        ids = self.words
        fresh = [w for w in {w for p in pieces for w in p} if w not in ids and isinstance(w, bytes)]
        texts = [b" ".join(fresh[i : i + 512]).decode() for i in range(0, len(fresh), 512)]
        flat = np.array([i for e in self.library.encode_batch_fast(texts, add_special_tokens=False) for i in e.ids], "<u4")
        # the library never merges over a space, and only a word's last token ends a word
        at = [0, *(4 * (np.flatnonzero(self.ends[flat]) + 1)).tolist()]
        if len(at) != len(fresh) + 1:
            raise ValueError("this tokenizer file doesn't mark the ends of words")
        raw = flat.tobytes()
        for w, i, j in zip(fresh, at, at[1:]):
            ids[w] = raw[i:j]
        out = [b"".join([ids[w] if isinstance(w, bytes) else int(w).to_bytes(4, "little") for w in p]) for p in pieces]
        for w in fresh:
            if len(w) > LONGEST_KEPT:
                del ids[w]
        return out


class Encoder(RunMemory):
    """ids of runs by lexicon or merging."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon | None):
        super().__init__()
        self.vocabulary, self.lexicon = vocabulary, lexicon
        self.split = Splitter(vocabulary)
        self.merger = Merger(vocabulary)
        self.words: dict[bytes, bytes] = {}  # of recent pre-tokens

    def resolve(self, runs: list[str]) -> list[bytes]:
        pieces = [self.split(r) for r in runs]
        if len(self.words) > REMEMBERED // 3:
            self.words.clear()
        ids = self.words
        words = [w for w in {w for p in pieces for w in p} if w not in ids and isinstance(w, bytes)]
        numbers = self.lexicon.numbers(words).tolist() if self.lexicon else [-1] * len(words)
        unseen = []
        for w, k in zip(words, numbers):
            if k >= 0:
                lex = self.lexicon
                ids[w] = lex.ids[lex.offsets[k] : lex.offsets[k + 1]].tobytes()
            elif len(w) > 64:
                ids[w] = np.array(self.vocabulary.merge(w), "<u4").tobytes()
            else:
                unseen.append(w)
        for w, x in zip(unseen, self.merger(unseen)):
            ids[w] = x
        out = [b"".join([ids[w] if isinstance(w, bytes) else int(w).to_bytes(4, "little") for w in p]) for p in pieces]
        for w in words:
            if len(w) > LONGEST_KEPT:
                del ids[w]
        return out


def decode(ids: Iterable[int], tokens: list[str]) -> str:
    """What the library's decode gives for a file without a decoder: tokens joined by a space."""
    return " ".join([tokens[i] for i in ids])


def count_words(docs: DataFrame, vocabulary: Vocabulary, text: str = "text") -> DataFrame:
    """(word, n): pre-tokens of all documents with their number, summed in the tasks first."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary.text)

    def run(batches):
        split, counts = kept(("splitter", shared.value), lambda: Splitter(Vocabulary(shared.value))), Counter()

        def sent():
            words: Counter = Counter()
            for r, n in counts.items():
                for w in split(r):
                    if isinstance(w, bytes) and len(w) <= LONGEST:
                        words[w] += n
            counts.clear()
            yield pa.RecordBatch.from_arrays([pa.array(words.keys(), pa.binary()), pa.array(words.values(), pa.int64())], names=["word", "n"])

        for b in batches:
            found = runs_of(b.column(0))[1]
            for r, n in zip(found.dictionary.to_pylist(), np.bincount(found.indices.to_numpy(), minlength=len(found.dictionary)).tolist()):
                counts[r] += n
            if len(counts) > COUNTED:
                yield from sent()
        yield from sent()

    return map_arrow(docs.select(text), run, "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counted: DataFrame, words: int) -> list[bytes]:
    """The ``words`` most frequent of (word, n), ties in the order of their bytes.

    A histogram of counts on a logarithmic scale (some hundred rows) finds the level that the last one is in,
    then the level's counts and, of the last count, the words' first bytes are counted in the same way, so never more than
    ``words`` rows come to the driver, and no task sorts all words.
    """
    out: list[bytes] = []

    def take(rows: DataFrame) -> None:
        out.extend(bytes(r[0]) for r in rows.select("word").collect())

    def narrowed(rows: DataFrame, key: Column, descending: bool) -> DataFrame | None:
        """Takes the groups of ``key`` that fit whole; returns the first that doesn't."""
        sizes = sorted(((r[0], r[1]) for r in rows.groupBy(key.alias("k")).agg(F.count("*")).collect()), reverse=descending)
        room, fit = words - len(out), 0
        for i, (k, n) in enumerate(sizes):
            if n > room - fit:
                if i:
                    take(rows.where(key > F.lit(k) if descending else key < F.lit(k)))
                return rows.where(key == F.lit(k)) if len(out) < words else None
            fit += n
        take(rows)
        return None

    left = narrowed(counted, F.floor(F.log2("n") * 16).cast("int"), True)
    left = None if left is None else narrowed(left, F.col("n"), True)
    at = 1
    while left is not None:  # a round for each byte that the words of one count share
        left = narrowed(left, F.hex(F.substring("word", at, 1)), False)
        at += 1
    return out


def build_lexicon(docs: DataFrame, vocabulary: Vocabulary, words: int = LEXICON_WORDS) -> str:
    """Compile the most frequent pre-tokens, at most ``words``, and hand the file to all executors; returns its name.

    Exactly the ``words`` most frequent are taken, ties in the order of their bytes. Executors that join
    later fetch the file, too.
    """
    counted = stored(count_words(docs, vocabulary), "words")
    compiled = Lexicon.compile(sorted(most_frequent(counted, words)), vocabulary.merge)
    dropped(counted)
    name = f"lexicon-{hashlib.sha256(compiled).hexdigest()[:24]}.bin"
    docs.sparkSession.sparkContext.addFile(put_file(docs.sparkSession, name, compiled))
    return name


def encoded(docs: DataFrame, path: str | None = None, words: int = LEXICON_WORDS, id_col: str = "doc_id", text: str = "text", with_ids: bool = False, with_text: bool = False) -> DataFrame:
    """One row for each row of ``docs``: id, n_tokens, ids_sha256, decoded_sha256, and as asked for ids (binary) and decoded."""
    spark = docs.sparkSession
    with open(path or tokenizer_path(), encoding="utf-8") as f:
        vocabulary = Vocabulary(f.read())
    name = build_lexicon(docs, vocabulary, words)
    shared = spark.sparkContext.broadcast(vocabulary.text)
    more = ", ids binary" * with_ids + ", decoded string" * with_text
    names = ["id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids, *["decoded"] * with_text]
    schema = f"id {docs.schema[id_col].dataType.simpleString()}, n_tokens bigint, ids_sha256 string, decoded_sha256 string{more}"

    def run(batches):
        encoder = kept(("encoder", name, shared.value), lambda: Encoder(Vocabulary(shared.value), Lexicon.open(SparkFiles.get(name))))
        own = encoder.vocabulary
        for b in batches:
            each = encoder.encode_each(b.column(1))
            decoded = [decode(x.tolist(), own.tokens) for x in each]
            ids = [x.tobytes() for x in each]
            columns = [
                b.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids], pa.string()),
                pa.array([hashlib.sha256(d.encode()).hexdigest() for d in decoded], pa.string()),
            ]
            if with_ids:
                columns.append(pa.array(ids, pa.binary()))
            if with_text:
                columns.append(pa.array(decoded, pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return map_arrow(docs.select(id_col, text), run, schema)


def op1_bpe_codec(docs: DataFrame) -> DataFrame:
    return encoded(docs).withColumnRenamed("id", "doc_id")
