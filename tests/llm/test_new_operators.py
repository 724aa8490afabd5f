"""Importance resampling, the byte-level transducer and the conversation trie."""

import base64
import hashlib
import math
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from quireflow.llm import prefix_trie, resampling, transducer
from quireflow.llm.common import tokenizer_path

SF = "/root/testdata/sf0.001"


# --- importance resampling

def features(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
    return w, w + [f"{a} {b}" for a, b in zip(w, w[1:])]


def resampled_plainly(docs, target, buckets=10_000, drawn=25, fewest=20):
    def counts(texts):
        n = [0] * buckets
        for t in texts:
            for f in features(t)[1]:
                n[zlib.crc32(f.encode()) % buckets] += 1
        return n

    s, t = counts(x for _, x in docs), counts(target)
    gain = [math.floor(1000 * math.log(((b + 1) * (sum(s) + buckets)) / ((a + 1) * (sum(t) + buckets)))) for a, b in zip(s, t)]
    rows = []
    for i, x in docs:
        w, f = features(x)
        weight = sum(gain[zlib.crc32(g.encode()) % buckets] for g in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    may = sorted((r for r in rows if r[5] >= fewest), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(may[: drawn * len(may) // 100]):
        r[4] = k + 1
    return sorted((tuple(r[:5]) for r in rows), key=repr)


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.read.parquet(f"{SF}/benchmark.parquet")


def test_resampling(spark, documents, benchmark):
    got = sorted(map(tuple, resampling.op11_importance_resampling(documents, benchmark).collect()), key=repr)
    assert got == resampled_plainly([tuple(r) for r in documents.select("doc_id", "text").collect()], [r[0] for r in benchmark.select("text").collect()])
    assert sum(r[4] is not None for r in got) > 20


def test_resampling_odd(odd, none, benchmark):
    docs = odd.select("doc_id", "text", F.lit(1).alias("row"), F.lit(2).alias("rank"), F.lit(3).alias("bucket"), F.lit(4).alias("w"))
    got = sorted(map(tuple, resampling.op11_importance_resampling(docs, benchmark).collect()), key=repr)
    # only the long text has 20 words, and a quarter of one document is none
    assert got == resampled_plainly([tuple(r) for r in odd.select("doc_id", "text").collect()], [r[0] for r in benchmark.select("text").collect()])
    assert resampling.op11_importance_resampling(none, benchmark).count() == 0
    assert resampling.op11_importance_resampling(odd, benchmark.where("false")).count() == odd.count()


def test_resampling_ties_and_repeats(spark, benchmark):
    text = " ".join(f"w{i}" for i in range(30))
    docs = spark.createDataFrame([(i // 4 if i < 40 else None, text) for i in range(48)], "doc_id long, text string").repartition(5)
    got = resampling.op11_importance_resampling(docs, benchmark).collect()
    ranks = sorted((r["rank"], -r["score"], r["doc_id"] is None, r["doc_id"] or 0) for r in got if r["rank"])
    assert [r[0] for r in ranks] == list(range(1, 13))
    assert [r[1:] for r in ranks] == sorted(r[1:] for r in ranks)
    assert min(-r[1] for r in ranks) >= max(r["score"] for r in got if r["rank"] is None)


def test_sample_gives_the_documents(documents, benchmark):
    out = resampling.sample(documents.withColumn("rank", F.lit("own")), benchmark)
    assert out.columns == [*documents.columns, "rank", "rank_"]
    want = {r["doc_id"]: r["rank"] for r in resampling.op11_importance_resampling(documents, benchmark).collect() if r["rank"]}
    assert {r["doc_id"]: r["rank_"] for r in out.collect()} == want


def test_resampling_stays_in_the_jvm(documents, benchmark):
    import io
    from contextlib import redirect_stdout

    own = resampling.featured(documents, "doc_id")
    counts = resampling.bucket_counts(own)
    text = documents.select(resampling.grams(resampling.words(F.col("text"))))
    for df in (resampling.weighed(own, resampling.gains(counts, resampling.bucket_counts(resampling.featured(benchmark, None)))), counts, text):
        with redirect_stdout(io.StringIO()) as plan:
            df.explain("formatted")
        assert "Python" not in plan.getvalue() and "Cartesian" not in plan.getvalue()


# --- the byte-level transducer

@pytest.fixture(scope="module")
def raw():
    with open(tokenizer_path("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        return f.read()


@pytest.fixture(scope="module")
def library(raw):
    import public_tokenizers
    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, raw.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


PARTS = ["a", "b", "aa", " ", "  ", "\n", "\t", "'s", "'", "’", "é", "日本", "語", "1", "²", "\xa0", " ", "　", "\x1c", "\x85", "😀", "ing", "the", "-", "_", "S", "'S", "'re", "\r\n", "Ⅳ", "ß", "İ", "́", "՘", "꟎"]


def ids_of(encoder, texts):
    return [memoryview(x).cast("I").tolist() for x in encoder.encode(texts)]


@pytest.mark.parametrize("most", [transducer.STATES, 50])
def test_transducer_equals_the_library(raw, library, most):
    encoder = transducer.Encoder(raw, transducer.character_codes())
    encoder.transducer.most = most  # a table that is full again and again
    rng = random.Random(most)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(3000)]
    texts += ["a" * 5000, "日" * 3000, " " * 500 + "x", "ab" * 3000 + "\n" * 70, "\n\n \n", "".join(chr(c) for c in range(1, 0x3000))]
    for i in range(0, len(texts), 500):
        assert ids_of(encoder, texts[i : i + 500]) == [library.encode_ordinary(t) for t in texts[i : i + 500]]
    assert encoder.transducer.lookahead <= 8  # bounded, however long a word is


def test_transducer_long_text_in_slices(raw, library, monkeypatch):
    monkeypatch.setattr(transducer, "SLICE", 100)
    encoder = transducer.Encoder(raw, transducer.character_codes())
    rng = random.Random(3)
    text = "".join(rng.choice([*PARTS, " word", " and", "\n\n  x"]) for _ in range(3000))
    assert ids_of(encoder, [text, "x" * 1000, text[:150]]) == [library.encode_ordinary(t) for t in (text, "x" * 1000, text[:150])]


def test_every_code_point_splits_as_in_the_library(raw, library):
    encoder = transducer.Encoder(raw, transducer.character_codes())
    points = [chr(c) for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF][::7]
    texts = ["".join(f"a{c}1 {c}" for c in points[i : i + 500]) for i in range(0, len(points), 500)]
    assert ids_of(encoder, texts) == [library.encode_ordinary(t) for t in texts]


def test_utf8_stream():
    rng = random.Random(5)
    for _ in range(5000):
        data = bytes(rng.choice(b"a\xe0\x80\xa0\xbf\xed\x9f\xf0\x90\xf4\x8f\xc2\xff\xe1\xf1") for _ in range(rng.randint(0, 12)))
        stream, out, at = transducer.Utf8Stream(), "", 0
        while at < len(data):
            k = rng.randint(1, 4)
            out += stream.feed(data[at : at + k])
            at += k
        assert out + stream.finish() == data.decode("utf-8", "replace")


def codec_plainly(library, text):
    ids = library.encode_ordinary(text or "")
    data = library.decode_bytes(ids)
    return len(ids), len(data.decode()), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(data).hexdigest()


def test_op12(documents, odd, none, library):
    for docs in (documents, odd.withColumn("id", F.lit(1)).withColumn("n_tokens", F.lit("x"))):
        out = transducer.op12_byte_bpe_transducer(docs)
        assert out.columns == ["doc_id", "n_tokens", "n_chars", "ids_sha256", "decoded_sha256"]
        want = [(r["doc_id"], *codec_plainly(library, r["text"])) for r in docs.select("doc_id", "text").collect()]
        assert sorted(map(tuple, out.collect()), key=repr) == sorted(want, key=repr)
    assert transducer.op12_byte_bpe_transducer(none).count() == 0


def test_encoded_with_ids_and_text(odd, library):
    for r in transducer.encoded(odd, with_ids=True, with_text=True).join(odd.select("doc_id", "text"), odd["doc_id"].eqNullSafe(F.col("id"))).collect():
        assert r["decoded"] == (r["text"] or "")
        assert memoryview(r["ids"]).cast("I").tolist() == library.encode_ordinary(r["text"] or "")


def test_rank_file_without_all_bytes_is_refused():
    with pytest.raises(ValueError):
        transducer.Ranks(base64.b64encode(b"a") + b" 0\n")


# --- the conversation trie

def trie_plainly(convs):
    """convs: id to a list of turns."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
        ends[tuple(turns)].append(c)
    nodes = list(members)
    kids, under = defaultdict(list), defaultdict(list)
    for p in nodes:
        if p:
            kids[p[:-1]].append(p)
        for d in range(len(p) + 1):
            under[p[:d]].append(p)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    rows = []
    for p in nodes:
        saved = sum((len(members[q]) - 1) * words(q) for q in under[p])
        digest = hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()
        rows.append((min(members[p]), len(p), min(members[p[:-1]]) if p else None, len(members[p]), len(kids[p]), sum(not kids[q] for q in under[p]), saved, digest))
    return sorted(rows, key=repr)


COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)


def random_convs(n, seed, hot=0):
    rng = random.Random(seed)
    convs = {c: [(rng.choice("ua"), f"{rng.choice('xyz')} w{rng.randint(0, 1)}") for _ in range(rng.randint(1, 6))] for c in range(n)}
    for c in range(n, n + hot):  # copies of one conversation, and of its beginning
        convs[c] = [("u", "hot one"), ("a", "hot two")][: 1 + c % 2]
    return convs


@pytest.mark.parametrize("n, hot, run_rows, range_rows", [(300, 0, 40, 25), (200, 300, 30, 40), (60, 0, 1, 1), (500, 50, 10_000, 10_000), (1, 0, 5, 5), (0, 9, 2, 2)])
def test_trie(spark, n, hot, run_rows, range_rows):
    convs = random_convs(n, n + hot, hot)
    out = prefix_trie.conversation_trie(conversations(spark, convs), run_rows=run_rows, range_rows=range_rows)
    assert out.columns == COLUMNS
    assert sorted(map(tuple, out.collect()), key=repr) == trie_plainly(convs)


def rebuilt_plainly(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            r, t = role or "", text or ""
            digest = hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()[:32]
            own[c].append((turn is not None, turn or 0, digest, (r, t)))
    own = {c: [x[3] for x in sorted(t)] for c, t in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = own.get(c - (abs(c) % 20) * (1 if c > 0 else -1), [])[:h] + turns[h:]
    return out


def test_op13(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    got = prefix_trie.op13_conversation_trie(rows, run_rows=7, range_rows=5)
    want = trie_plainly(rebuilt_plainly([tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]))
    assert sorted(map(tuple, got.select(*COLUMNS).collect()), key=repr) == want


def test_op13_odd(spark):
    rows = [
        (0, 0, "user", "hello there you"), (0, None, "user", None), (0, 1, None, "a  b"), (0, 1, None, "a  b"), (7, 0, "user", "hello there you"), (27, 5, "u", "x y"), (None, 0, "user", "of none"),
        (8, 0, "user", "word " * 20_000), (9, 0, "user", ""), (-5, 0, "u", "x"), (45, None, None, None), (46, 2, "", ""),
    ]
    df = spark.createDataFrame([(*r, 1, "x", b"k") for r in rows], "conv_id long, turn long, role string, text string, part int, slot string, key binary")
    want = trie_plainly(rebuilt_plainly(rows))
    assert any(r[1] == 0 and r[3] == 8 for r in want)
    for range_rows in (2, 100):
        assert sorted(map(tuple, prefix_trie.op13_conversation_trie(df, run_rows=3, range_rows=range_rows).select(*COLUMNS).collect()), key=repr) == want
    assert prefix_trie.op13_conversation_trie(df.where("false")).count() == 0


def test_loser_tree_compares_no_shared_turn_twice(monkeypatch):
    """Every turn compared either ends a comparison or becomes part of an LCP that is never compared again."""
    rng = random.Random(9)
    size = prefix_trie.SIZE
    keys = sorted(b"".join(bytes([0] * (size - 1) + [rng.randint(0, 1)]) for _ in range(rng.randint(0, 12))) for _ in range(400))
    pieces = [[(k, c) for c, k in enumerate(keys) if c % 8 == p] for p in range(8)]
    flat, starts, lcps = [], [], []
    for piece in pieces:
        starts.append(len(flat))
        lcps += [0, *[prefix_trie.lcp(a[0], b[0]) for a, b in zip(piece, piece[1:])]]
        flat += piece
    compared, shared = [0], prefix_trie.lcp

    def counting(a, b, at=0):
        n = shared(a, b, at)
        compared[0] += n - at + 1
        return n

    monkeypatch.setattr(prefix_trie, "lcp", counting)
    out = list(prefix_trie.merged([f[0] for f in flat], [f[1] for f in flat], lcps, starts))
    assert [flat[i] for i, _ in out] == sorted(flat)
    assert [n for _, n in out] == [0, *[shared(a, b) for a, b in zip(keys, keys[1:])]]
    assert compared[0] <= 400 * 4 + sum(len(k) // size for k in keys)
