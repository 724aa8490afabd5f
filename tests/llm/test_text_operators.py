"""BPE, ids in files, edits, SimHash, substrings, quality, against brute force; odd inputs for each."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from quireflow.llm import bpe, common, edit_counts, huffman, quality, sharding, simhash, similar, substring

tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(common.tokenizer_path())


@pytest.fixture(scope="module")
def vocabulary():
    with open(common.tokenizer_path(), encoding="utf-8") as f:
        return bpe.Vocabulary(f.read())


def rows(df):
    return df.select("doc_id", "text").collect()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


TRICKY = ["Hello it's 42 <|endoftext|>x<|startoftext|>", "<|ENDOFTEXT|>", "a\x1cb\x85c d é Å Σίσυφος ΟΔΥΣΣΕΥΣ ﬁ ½", "'" * 90 + "sss", "x" * 3000 + " " + "ab" * 2000, "İstanbul ẞ don't WE'LL", "\U0001f600 日本語 ١٢٣", "", " \n", None]


def test_encoders_agree_with_the_library(library, vocabulary):
    texts = pa.array(TRICKY, pa.string())
    lexicon = bpe.Lexicon(bpe.Lexicon.compile(sorted({b"hello", b"don", b"'t", b"we"}), vocabulary.merge))
    for encoder in (bpe.Encoder(vocabulary, lexicon), bpe.Encoder(vocabulary, None), bpe.LibraryEncoder(vocabulary.text)):
        for _ in range(2):  # from the library, then from memory
            for text, ids in zip(TRICKY, encoder.encode_each(texts)):
                expect = library.encode(text or "", add_special_tokens=False).ids
                assert ids.tolist() == expect
                assert bpe.decode(ids.tolist(), vocabulary.tokens) == library.decode(expect, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"])
def test_capitals_that_compose_only_in_lower_case(library, vocabulary, text):
    texts = [text, f"Aa {text}ber AA <|endoftext|> {text}"]
    for encoder in (bpe.Encoder(vocabulary, None), bpe.LibraryEncoder(vocabulary.text)):
        for t, ids in zip(texts, encoder.encode_each(pa.array(texts))):
            assert ids.tolist() == library.encode(t, add_special_tokens=False).ids
    counter = edit_counts.Counter(vocabulary.text)
    assert counter(text) == (1, len(library.encode(text, add_special_tokens=False).ids))


@settings(max_examples=60, deadline=None)
@given(st.lists(st.binary(min_size=1, max_size=70).filter(lambda b: not set(b) & set(b" \t\n\r\x0b\x0c")), min_size=1, max_size=20))
def test_merger_is_merge(vocabulary, ws):
    ws = sorted({w[:64] for w in ws})
    assert [np.frombuffer(x, "<u4").tolist() for x in bpe.Merger(vocabulary)(ws)] == [vocabulary.merge(w) for w in ws]


@settings(max_examples=60, deadline=None)
@given(st.sets(st.binary(min_size=1, max_size=8), max_size=60), st.lists(st.binary(min_size=1, max_size=8), max_size=20))
def test_lexicon_is_minimal_and_exact(ws, others):
    ws = sorted(ws)
    lexicon = bpe.Lexicon(bpe.Lexicon.compile(ws, lambda w: list(w)))
    assert lexicon.numbers(ws).tolist() == list(range(len(ws)))
    assert all((n >= 0) == (w in ws) for w, n in zip(others, lexicon.numbers(others).tolist()))
    right = {frozenset(w[len(p):] for w in ws if w.startswith(p)) for w in ws for p in [w[:i] for i in range(len(w) + 1)]} if ws else set()
    assert len(lexicon.final) <= len(right) + 1  # one state for each set of suffixes, and the start


def test_lexicon_has_exactly_the_most_frequent_words(spark):
    """Ties in the order of their bytes, however many words one count has."""
    rng = random.Random(6)
    counts = {f"w{rng.randrange(10**6)}".encode(): rng.choice([1, 1, 1, 2, 7, 900]) for _ in range(520)} | {b"a": 1, b"ab": 1, b"abc": 1, bytes([255]): 1}
    df = spark.createDataFrame([(bytearray(w), n) for w, n in counts.items()], "word binary, n long")
    for words in (0, 1, 3, 100, 300, len(counts), 10**6):
        want = sorted(counts, key=lambda w: (-counts[w], w))[:words]
        assert sorted(bpe.most_frequent(df, words)) == sorted(want)
    assert bpe.most_frequent(df.where("false"), 5) == []


def test_other_vocabularies_are_refused():
    import json

    for name in ("byte_bpe_50k.json",):
        with open(common.tokenizer_path(name), encoding="utf-8") as f, pytest.raises(ValueError, match="normalizer"):
            bpe.Vocabulary(f.read())
    with open(common.tokenizer_path(), encoding="utf-8") as f:
        spec = json.load(f)
    bpe.check_spec(spec)
    spec["added_tokens"][0]["lstrip"] = True
    with pytest.raises(ValueError, match="added token"):
        bpe.check_spec(spec)


def test_op1(spark, documents, odd, none, library):
    for df in (documents, odd):
        got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.op1_bpe_codec(df).collect())
        expect = Counter()
        for r in rows(df):
            ids = library.encode(r["text"] or "", add_special_tokens=False).ids
            raw, text = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
            expect[r["doc_id"], len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(text.encode()).hexdigest()] += 1
        assert got == expect
    assert bpe.op1_bpe_codec(none).count() == 0


def test_op6(spark, documents, odd, none, library):
    for df in (documents, odd):
        got = sorted(map(tuple, huffman.op6_huffman_ids(df).collect()), key=lambda r: r[1])
        expect = {}
        for r in rows(df):
            ids = np.array([*library.encode(r["text"] or "", add_special_tokens=False).ids, 1], "<u4")
            expect.setdefault(r["doc_id"], []).append((len(ids), zlib.crc32(ids.tobytes())))
        start = 0
        order = [r[0] for r in got]
        assert order == sorted(order, key=lambda i: (i is not None, i))
        for doc, first, n, crc in got:
            assert first == start and (n, crc) in expect[doc]
            expect[doc].remove((n, crc))
            start += n
        assert not any(expect.values())
    assert huffman.op6_huffman_ids(none).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(1, 10**12), min_size=1, max_size=300), st.integers(9, 20), st.integers(0, 2**32))
def test_huffman_round_trip(counts, most, seed):
    n = np.array(counts, np.int64)
    lengths = huffman.code_lengths(n, most)
    assert lengths.max() <= most and sum(2.0 ** -int(x) for x in lengths) <= 1
    ids = np.random.default_rng(seed).choice(60_000, len(n), replace=False)
    code = huffman.Code(ids, lengths)
    x = ids[np.random.default_rng(seed + 1).integers(0, len(n), 1000)]
    payload, marks = code.encode(x)
    assert (code.decode(payload, marks, len(x)) == x).all()


def test_huffman_is_optimal_without_a_limit():
    import heapq

    n = np.random.default_rng(5).integers(1, 1000, 200)
    heap = [int(x) for x in n]
    heapq.heapify(heap)
    total = 0
    while len(heap) > 1:
        both = heapq.heappop(heap) + heapq.heappop(heap)
        total += both
        heapq.heappush(heap, both)
    assert int((huffman.code_lengths(n) * n).sum()) == total


def test_edit_trees(library, vocabulary):
    counter = edit_counts.Counter(vocabulary.text)
    rng = random.Random(3)
    alphabet = [*"ab c.'s \n\t1é ", "<|endoftext|>", "don't", "  "]
    for _ in range(60):
        text = "".join(rng.choices(alphabet, k=rng.choice([0, 1, 5, 50, 400])))
        tree = edit_counts.Tree.of(text, counter, size=rng.choice([1, 2, 4]))
        for _ in range(8):
            at, cut, put = rng.randint(0, len(text) + 2), rng.choice([0, 1, 3, 50]), "".join(rng.choices(alphabet, k=rng.choice([0, 1, 3, 60])))
            tree.edit(at, cut, put)
            at = min(at, len(text))
            text = text[:at] + put + text[at + cut :]
            assert "".join(tree.text) == text and tree.total == len(library.encode(text, add_special_tokens=False).ids)


def edited(text, edits):
    for e in edits:
        at = min(max(e["at"] or 0, 0), len(text))
        text = text[:at] + (e["put"] or "") + text[at + max(e["cut"] or 0, 0) :]
    return text


def test_op3(documents, odd, none, library):
    from pyspark.sql import functions as F

    size = lambda x: len(library.encode(x, add_special_tokens=False).ids)
    for df in (documents, odd):
        got = Counter((r["doc_id"], r["n_tokens"], r["n_tokens_after"], r["n_chars_after"]) for r in edit_counts.op3_edit_aware_counts(df).collect())
        expect = Counter()
        for r in df.select("doc_id", "text", edit_counts.scripted(F.col("doc_id"), F.coalesce(F.length("text"), F.lit(0))).alias("e")).collect():
            text = r["text"] or ""
            after = edited(text, r["e"])
            expect[r["doc_id"], size(text), size(after), len(after)] += 1
        assert got == expect
    assert edit_counts.op3_edit_aware_counts(none).count() == 0


def test_trees_are_kept(spark, library):
    """Two rounds of edits, each from the stored trees alone: only touched leaves are encoded, the totals are the library's."""
    rng = random.Random(4)
    texts = {i: " ".join(f"word{rng.randrange(500)}" for _ in range(n)) for i, n in enumerate([0, 1, 5, 400, 3000])}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    trees = common.stored(edit_counts.build_trees(docs), "trees")
    rows = 0
    for turn in range(2):
        edits = [(i, k, rng.randrange(0, len(t) + 1), rng.randrange(0, 9), rng.choice([" x y", "", "Zz"])) for i, t in texts.items() if i % 2 or turn for k in range(2)]
        table = spark.createDataFrame([*edits, (None, 0, 0, 1, "q")], "doc_id long, seq int, at long, cut long, put string")
        joined, column = edit_counts.edit_lists(trees, table)
        out = common.stored(edit_counts.apply_edits(joined, column), "trees")
        for i, *_ in edits[::2]:
            texts[i] = edited(texts[i], [{"at": e[2], "cut": e[3], "put": e[4]} for e in edits if e[0] == i])
        for r in out.collect():
            rows += 1
            assert "".join(r["leaves"]) == texts[r["id"]] and r["n_chars_after"] == len(texts[r["id"]]) == r["chars"][1]
            assert r["n_tokens_after"] == r["tokens"][1] == len(library.encode(texts[r["id"]], add_special_tokens=False).ids)
            assert r["n_runs_encoded_again"] <= r["n_edits"] * 4 * edit_counts.LEAF
            if not r["n_edits"]:
                assert r["n_runs_encoded_again"] == 0
        trees = out.select("id", "leaves", "chars", "tokens")
    assert rows == 10


def test_edits_as_a_table(spark, library):
    docs = spark.createDataFrame([(1, "one two"), (2, "x"), (None, "y")], "doc_id long, text string")
    edits = spark.createDataFrame([(1, 2, 0, 3, "1"), (1, 1, 7, 0, " three"), (None, 1, None, None, None)], "doc_id long, seq int, at long, cut long, put string")
    trees = edit_counts.build_trees(docs).selectExpr("*", "'clash' as edits")
    joined, column = edit_counts.edit_lists(trees, edits)
    assert len(set(joined.columns)) == len(joined.columns)
    out = {r["id"]: r for r in edit_counts.apply_edits(joined, column).collect()}
    assert out[1]["n_tokens_after"] == len(library.encode("1 two three", add_special_tokens=False).ids) and out[2]["n_edits"] == 0 and out[None]["n_edits"] == 1


# SimHash


def plain_fingerprint(text, k=3):
    import xxhash

    w = ["".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in x) for x in words(text)]
    grams = [" ".join(w[i : i + k]) for i in range(len(w) - k + 1)] if len(w) >= k else [" ".join(w)] if w else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), 42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def reachable(keys, linked):
    comp = {k: k for k in keys}
    changed = True
    while changed:
        changed = False
        for a, b in linked:
            low = min(comp[a], comp[b])
            if comp[a] != low or comp[b] != low:
                comp[a] = comp[b] = low
                changed = True
    return comp


def test_op2(documents, odd, none):
    for df in (documents, odd.where("doc_id is not null")):
        got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in simhash.op2_simhash_near_dedup(df).collect()}
        fp = {r["doc_id"]: plain_fingerprint(r["text"]) for r in rows(df)}
        comp = reachable(fp, [(a, b) for a in fp for b in fp if a < b and bin(fp[a] ^ fp[b]).count("1") <= 2])
        assert got == {(d, f"{f:016x}", comp[d]) for d, f in fp.items()}
    assert simhash.op2_simhash_near_dedup(odd).count() == 9
    assert simhash.op2_simhash_near_dedup(none).count() == 0


@pytest.mark.parametrize("bucket, radius", [(0, 2), (2, 2), (64, 2), (0, 1), (64, 1), (0, 0)])
def test_links_with_heavy_buckets(spark, bucket, radius):
    """Fingerprints in one bucket, over the cap: the exact way gives the same parts."""
    rng = random.Random(bucket)
    fps = {0}
    for _ in range(150):
        f = rng.choice(sorted(fps))
        for _ in range(rng.choice([1, 2, 3, 4])):
            f ^= 1 << rng.randrange(64)
        fps.add(f)
    signed = {f - (1 << 64) if f >> 63 else f for f in fps}
    expect = reachable(signed, [(a, b) for a in signed for b in signed if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= radius])
    edges = [(r["u"], r["v"]) for r in simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), radius, bucket=bucket).collect()]
    assert reachable(signed, edges) == expect


def test_balls_cover():
    for radius in range(6):
        for m in range(1, 5):
            assert sum(b + 1 for b in simhash.balls(radius, m)) == radius + 1


def test_similar_documents(spark, odd, none):
    rng = random.Random(1)
    base = [[f"w{rng.randrange(4000)}" for _ in range(300)] for _ in range(40)]
    docs = [(i, " ".join(b)) for i, b in enumerate(base)]
    near = [(100 + i, " ".join(b[:150] + ["changed"] + b[151:])) for i, b in enumerate(base)]  # similarity 0.97
    far = [(200 + i, " ".join(b[:150] + [f"v{rng.randrange(4000)}" for _ in range(150)])) for i, b in enumerate(base)]  # about 0.33
    df = spark.createDataFrame(docs + near + far + [(300, docs[0][1])], "doc_id long, text string")
    kept = {r["doc_id"] for r in similar.without_near_duplicates(df).collect()}
    assert kept == {i for i, _ in docs} | {i for i, _ in far}
    out = similar.without_near_duplicates(odd)
    assert out.columns == odd.columns
    assert Counter(r["doc_id"] for r in out.collect()) == Counter([1, 2, None, 4, 5, 6])
    assert similar.without_near_duplicates(none).count() == 0


def test_similar_takes_any_column_names(spark):
    """Columns named like the stage's own, and words kept apart by fingerprints alone."""
    rows = [(1, "a b c d e f g h", 1, "x", "k"), (2, "a b c d e f g h", 2, "y", "k"), (None, None, 3, "z", None), (None, "", 4, "z", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _id long, _digest string, _text_digest string")
    out = similar.without_near_duplicates(df)
    assert out.columns == df.columns and {(r["doc_id"], r["text"] or "") for r in out.collect()} == {(1, rows[0][1]), (None, "")}


def test_similar_candidates_do_not_depend_on_size():
    """Bands have no parameter that follows the table's size: pairs at 0.8 meet, unlike ones of a million don't."""
    rng = np.random.default_rng(8)
    met = 0
    for _ in range(400):
        own = rng.integers(0, 2**63, 300, dtype=np.uint64)
        other = np.concatenate([own[:267], rng.integers(0, 2**63, 33, dtype=np.uint64)])  # Jaccard 267 / 333
        met += (similar.bands_of(np.sort(own)) == similar.bands_of(np.sort(other))).any()
    assert met >= 398
    keys = np.concatenate([similar.bands_of(rng.integers(0, 2**63, 50, dtype=np.uint64)) for _ in range(2000)])
    assert len(np.unique(keys)) == len(keys)



def test_similar_ignores_how_often_a_line_repeats(spark):
    rng = random.Random(5)
    line = " ".join(f"line{i}" for i in range(9))
    own = [[f"{d}x{rng.randrange(9999)}" for _ in range(200)] for d in range(6)]
    df = spark.createDataFrame([(i, "\n".join([" ".join(w), *[line] * 20])) for i, w in enumerate(own)], "doc_id long, text string")
    assert {r["doc_id"] for r in similar.without_near_duplicates(df).collect()} == set(range(6))
    copy = [(10 + i, "\n".join([" ".join(w), *[line] * 3])) for i, w in enumerate(own)]  # the same shingles, counted otherwise
    both = df.unionAll(spark.createDataFrame(copy, df.schema))
    assert {r["doc_id"] for r in similar.without_near_duplicates(both).collect()} == set(range(6))



@pytest.mark.parametrize("block", [similar.BLOCK, 300])
def test_similar_is_brute_force(spark, monkeypatch, block):
    """Pairs and chains at 0.75 to 0.9, and exactly 0.8, against all pairs."""
    monkeypatch.setattr(similar, "BLOCK", block)
    rng = random.Random(9)
    docs = []
    for i in range(120):
        base = [f"w{rng.randrange(10**6)}" for _ in range(204)]  # 200 shingles
        docs.append(base)
        for _ in range(rng.choice([1, 1, 1, 4])):  # more copies, each of the one before
            same = rng.randrange(171, 191)  # shingles of its start that stay: 0.748 to 0.913
            base = base[: same + 4] + [f"v{rng.randrange(10**6)}" for _ in range(200 - same)]
            docs.append(base)
    long = [f"u{i}" for i in range(9)]
    docs += [long[:8], long, long[:4] + ["end"], long[:4] + ["end", "x"]]  # Jaccard of exactly 4/5, and of 1/2
    sets = [{tuple(d[i : i + 5]) for i in range(len(d) - 4)} for d in docs]
    pairs = [(i, j) for j in range(len(docs)) for i in range(max(0, j - 6), j) if len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= 0.8]
    assert len(pairs) > 60 and any(sets[j] and 0.75 < len(sets[j - 1] & sets[j]) / len(sets[j - 1] | sets[j]) < 0.8 for j in range(1, len(docs)))
    comp = reachable(range(len(docs)), pairs)
    df = spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")
    got = {r["id"]: r["class_id"] for r in similar.duplicate_classes(df).collect()}
    assert got == {i: comp[i] for i in range(len(docs))}



# substrings


def removed(docs, window):
    seen = Counter()
    split = [words(t) for t in docs]
    for w in split:
        seen.update(tuple(w[i : i + window]) for i in range(len(w) - window + 1))
    out = []
    for w in split:
        stay = [True] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                stay[i : i + window] = [False] * window
        out.append((len(w), stay.count(False), hashlib.sha256(" ".join(x for x, s in zip(w, stay) if s).encode()).hexdigest()))
    return out


def test_op8(documents, odd, none):
    for df in (documents, odd.where("doc_id <> 4 or doc_id is null")):
        got = Counter(tuple(r) for r in substring.op8_substring_dedup(df).collect())
        r = rows(df)
        assert got == Counter((x["doc_id"], *y) for x, y in zip(r, removed([x["text"] for x in r], 35)))
    one = [r for r in substring.op8_substring_dedup(odd).collect() if r["doc_id"] == 4][0]
    assert (one["n_words"], one["n_removed"]) == (30_000, 30_000)
    assert substring.op8_substring_dedup(none).count() == 0
    assert substring.repeats(odd, keep=True).columns == odd.columns


@pytest.mark.parametrize("bits, each", [(2, 1 << 20), (8, 2000)])
def test_sketch_loses_none(spark, documents, monkeypatch, bits, each):
    """Counters that all windows share only estimate too many as repeated; many small chunks and buckets change nothing."""
    monkeypatch.setattr(substring, "width_bits", lambda n: bits)
    monkeypatch.setattr(substring, "CHUNK_BYTES", each)
    monkeypatch.setattr(substring, "BUCKET_BYTES", each)
    got = Counter(tuple(r) for r in substring.op8_substring_dedup(documents).collect())
    r = rows(documents)
    assert got == Counter((x["doc_id"], *y) for x, y in zip(r, removed([x["text"] for x in r], 35)))


@pytest.mark.parametrize("window", [1, 3, 9])
def test_short_windows(spark, window):
    rng = random.Random(window)
    texts = [" ".join(rng.choices("abc", k=rng.randrange(0, 30)) + [f"u{i}"] * rng.randrange(3)) for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: tuple(r)[1:] for r in substring.repeats(df, window=window).collect()}
    assert got == dict(enumerate(removed(texts, window)))


# quality


def plain_measures(text, lang=None):
    text = text or ""
    w = words(text)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = Counter(grams)
    hit = {i + j for i, g in enumerate(grams) if n[g] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words(x)]
    trimmed = [x.strip(" \t\n\x0b\x0c\r") for x in lines]
    top = max(Counter(zip(w, w[1:])).values(), default=0)
    stop = quality.STOP_WORDS.get(lang)
    low = lambda x: "".join(c.lower() if c.isascii() else c for c in x)
    return {
        "n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(hit),
        "n_bare_words": sum(not any(c.isalpha() and c.isascii() or ord(c) > 127 for c in x) for x in w), "n_digits": sum(c in "0123456789" for c in text), "n_upper": sum("A" <= c <= "Z" for c in text),
        "n_ellipsis_lines": sum(x.endswith("...") or x.endswith("…") for x in trimmed), "n_bullet_lines": sum(x[0] in "-*•|" for x in trimmed), "longest_word": max(map(len, w), default=0),
        "n_top_pair": 2 * top if top > 1 else 0, "n_stop_words": -1 if stop is None else sum(low(x) in stop for x in w),
    }


def test_op9(documents, odd, none):
    from pyspark.sql import functions as F

    for df in (documents, odd, odd.withColumn("lang", F.when(F.col("source") == "a", "EN").otherwise("en"))):
        got = Counter(tuple(r[m] for m in ["doc_id", *quality.MEASURES, "base_failed"]) for r in quality.op9_quality_rules(df).collect())
        expect = Counter()
        for r in df.collect():
            m = plain_measures(r["text"], r["lang"] if "lang" in df.columns else None)
            expect[r["doc_id"], *[m[x] for x in quality.MEASURES], m["n_words"] < 50 or 100 * m["n_repeat_words"] > 50 * m["n_words"]] += 1
        assert got == expect
    assert all(not r["kept"] for r in quality.op9_quality_rules(documents).collect() if r["base_failed"])
    assert quality.op9_quality_rules(none).count() == 0
    assert quality.apply_policy(odd).columns == odd.columns


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aB1- .…•\n\té#", max_size=60), st.sampled_from([None, "en", "xx"]))
def test_measures(text, lang):
    assert dict(zip(quality.MEASURES, quality.measure(text, lang))) == plain_measures(text, lang)


def test_ledger_is_stored_by_version(spark, documents, tmp_path):
    quality.write_ledger(documents, str(tmp_path))
    led = quality.read_ledger(spark, str(tmp_path))
    assert led.count() == documents.count()
    kept = {p: quality.judged(led, p).where("kept").count() for p in quality.POLICIES}
    assert kept["v1"] >= kept["v2"] >= kept["v3"] > 0


def test_ablations(documents):
    led = quality.ledger(documents)
    bits = [r["fail_bits"] for r in led.collect()]
    mask = quality.POLICIES["v2"]
    for r in quality.ablations(led, "v2").collect():
        b = quality.BIT[r["rule"]]
        assert (r["n_failing"], r["n_failing_alone"], r["n_kept_without"]) == (sum(x & b > 0 for x in bits), sum(x & mask == b for x in bits), sum(x & mask & ~b == 0 for x in bits))


# sharding


@pytest.mark.parametrize("limit", [500, 5000, 10**9])
def test_op5(documents, odd, none, limit):
    out = sharding.shards(documents, limit).collect()
    assert len(out) == documents.count()
    total = Counter()
    for r in out:
        total[r["depth"], r["prefix"], r["page"]] += r["bytes"]
    alone = Counter((r["depth"], r["prefix"], r["page"]) for r in out)
    assert all(n <= limit or alone[k] == 1 for k, n in total.items())
    whole = Counter()
    for r in out:  # a bucket was split only if it had to be
        for d in range(r["depth"]):
            whole[d, r["prefix"] >> (r["depth"] - d)] += r["bytes"]
    assert all(n > limit for n in whole.values())
    assert sharding.shards(odd, limit).count() == 9
    assert sharding.shards(none, limit).count() == 0


def test_equal_rows_go_to_pages(spark):
    df = spark.createDataFrame([(1, "x" * 100)] * 50 + [(2, "y")], "doc_id long, text string").repartition(3)
    pages = Counter((r["prefix"], r["page"]) for r in sharding.shards(df, 1000).collect())
    assert max(pages.values()) == 10 and len(pages) == 6


def test_written_shards(spark, odd, documents, tmp_path):
    """Each shard is one file whose texts are within the limit, but for a single row over it; no row is lost."""
    for name, df, limit in (("a", documents, 20_000), ("b", odd, 100)):
        to = str(tmp_path / name)
        sharding.write_shards(df, to, limit)
        back = spark.read.parquet(to)
        assert sorted(map(str, back.select(*df.columns).collect())) == sorted(map(str, df.collect()))
        sizes = Counter()
        for r in back.collect():
            sizes[r["shard"]] += len((r["text"] or "").encode())
        alone = Counter(r["shard"] for r in back.collect())
        assert all(n <= limit or alone[s] == 1 for s, n in sizes.items())
        files = Counter(p.parent.name for p in (tmp_path / name).rglob("*.parquet"))
        assert set(files.values()) == {1} and len(files) == len(sizes)
