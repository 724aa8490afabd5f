"""Embeddings, language model, mixing, and the pipeline, against brute force."""

import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quireflow.llm import katz, mixing, pivots

import corpus_pipeline


def cosines(x):
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    return x @ x.T


def test_op4_recall_and_rows(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(1500, 64))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    n = rng.normal(size=q.shape)
    n -= (n * q).sum(1, keepdims=True) * q
    n /= np.linalg.norm(n, axis=1, keepdims=True)
    y = 0.905 * q + math.sqrt(1 - 0.905**2) * n
    group = q[0] + 0.02 * rng.normal(size=(300, 64))
    z = np.concatenate([q, y, group, q[:5]])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(z)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r for r in pivots.op4_pivot_near_dedup(df).collect()}
    links = cosines(z) >= 0.9
    np.fill_diagonal(links, False)
    true = links.sum(axis=1)
    found = np.array([got[i]["n_links"] for i in range(len(z))])
    assert (found <= true).all() and found.sum() >= 0.97 * true.sum()
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert len({got[i]["component_id"] for i in range(3000, 3300)}) == 1


def test_op4_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(4)
    x = rng.normal(size=16) + 0.01 * rng.normal(size=(100, 16))
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)], "vec_id long, embedding array<double>")
    out = pivots.op4_pivot_near_dedup(df).collect()
    assert {(r["n_links"], r["component_id"]) for r in out} == {(99, 0)}


@pytest.mark.parametrize("d, pivots_, mean", [(64, 1024, 0.0), (64, 1024, 0.6), (384, 1024, 0.5), (1536, 256, 0.5)])
def test_op4_description_recalls(d, pivots_, mean):
    """Pairs at cosine 0.902, where rows share a direction and where they don't, meet in a list."""
    rng = np.random.default_rng(7)
    unit = lambda x: x / np.linalg.norm(x, axis=1, keepdims=True)
    centre = unit(rng.standard_normal((1, d)))
    draw = lambda n: unit(np.sqrt(mean) * centre + np.sqrt(1 - mean) * unit(rng.standard_normal((n, d))))
    chosen, a = draw(pivots_), draw(400)
    r = rng.standard_normal(a.shape)
    r -= (r * a).sum(1, keepdims=True) * a
    b = 0.902 * a + math.sqrt(1 - 0.902**2) * unit(r)
    k = pivots.described_by(pivots_)
    x, y = pivots.nearest_pivots(a, chosen, k), pivots.nearest_pivots(b, chosen, k)
    assert ((x[:, :, None] == y[:, None, :]).any(2).sum(1) >= pivots.SHARED).mean() >= 0.97


def test_op4_each_pair_is_retrieved_once():
    """Over all lists, whole or parted by a second pivot, a pair that shares two pivots is met exactly once."""
    rng = np.random.default_rng(1)
    own = np.stack([rng.choice(30, 6, replace=False) for _ in range(60)]).astype(np.int32)
    for parted in (set(), {0, 3, 7, 20}, set(range(30))):
        met = np.zeros((60, 60), int)
        for p in range(30):
            has = np.flatnonzero((own == p).any(1))
            for q in range(p + 1, 30) if p in parted else [-1]:
                both = has if q < 0 else has[(own[has] == q).any(1)]
                if len(both):
                    met[np.ix_(both, both)] += pivots.retrieved(own[both], own[both], p, q, 2)
        shares = (own[:, None, :, None] == own[None, :, None, :]).any(3).sum(2)
        assert (met == (shares >= 2)).all()


@pytest.mark.parametrize("split", [10**9, 8])
def test_op4_parted_lists(spark, monkeypatch, split):
    """Lists that are parted by a second pivot, and cut into blocks, find the same links."""
    monkeypatch.setattr(pivots, "SPLIT", split)
    monkeypatch.setattr(pivots, "BLOCK", 16)
    rng = np.random.default_rng(5)
    z = np.concatenate([rng.normal(size=(200, 24)), rng.normal(size=24) + 0.05 * rng.normal(size=(90, 24)), np.repeat(rng.normal(size=(2, 24)), 5, axis=0)])
    df = spark.createDataFrame([(i, [float(v) for v in x]) for i, x in enumerate(z)], "vec_id long, embedding array<double>")
    got = {r["vec_id"]: r["n_links"] for r in pivots.op4_pivot_near_dedup(df).collect()}
    links = cosines(z) >= 0.9
    np.fill_diagonal(links, False)
    found = np.array([got[i] for i in range(len(z))])
    assert (found <= links.sum(1)).all() and found.sum() >= 0.97 * links.sum() and (found[200:290] == 89).all()


def test_op4_odd(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, [0.0, 0.0]), (3, [nan, 1.0]), (4, [None, 1.0]), (5, []), (6, [1.0, 2.0]), (7, [2.0, 4.0]), (8, [1.0, 2.0, 3.0]), (9, [inf, 1.0]), (None, [1.0, 2.0]), (6, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = Counter(tuple(r) for r in pivots.op4_pivot_near_dedup(df).collect())
    lone = {(i, 0, i, True): 1 for i in (1, 2, 3, 4, 5, 8, 9)}
    assert got == Counter(lone) + Counter({(6, 3, 6, True): 2, (7, 3, 6, False): 1, (None, 3, 6, False): 1})
    assert pivots.op4_pivot_near_dedup(df.where("false")).count() == 0


# language model


def brute(texts, held, order):
    """The model written out in the plainest way."""
    docs = [[w.lower() for w in (t or "").encode().split()] + [b"\n"] for t in texts]
    padded = [[b" "] * (order - 1) + w for w in docs]
    counts = [Counter() for _ in range(order)]  # of grams, as tuples, by their length
    after = defaultdict(dict)
    for w, h in zip(padded, held):
        for i in range(order - 1, len(w)):
            for k in range(1, order + 1):
                if not h:
                    counts[k - 1][tuple(w[i - k + 1 : i + 1])] += 1
    for c in counts[1:]:
        for g, r in c.items():
            after[g[:-1]][g[-1]] = r
    ds = [katz.discounts([Counter(c.values())[r] for r in range(1, 7)])[0] for c in counts]
    d = lambda k, r: ds[k - 1][r] if r <= 5 else 1.0
    uni = {g[0]: r for g, r in counts[0].items()}
    total, types = sum(uni.values()), len(uni)
    left = sum((1 - d(1, r)) * r for r in uni.values())
    size = total if left > 0 else total + 1

    def prob(h, w):
        if not h:
            return d(1, uni[w]) * uni[w] / size if w in uni else (left if left > 0 else 1) / size
        if h not in after:
            return prob(h[1:], w)
        k, n = len(h) + 1, sum(after[h].values())
        more = n > 5
        if w in after[h]:
            return d(k, after[h][w]) * after[h][w] / (n + more)
        rest = sum((1 - d(k, r)) * r for r in after[h].values()) + more
        return rest / (n + more) / (1 - sum(prob(h[1:], x) for x in after[h])) * prob(h[1:], w)

    out = []
    for w, p, h in zip(docs, padded, held):
        base = sum(math.log10((uni.get(x, 0) + 1) / (total + types + 1)) for x in w)
        score = sum(math.log10(prob(tuple(p[i - order + 1 : i]), p[i])) for i in range(order - 1, len(p)))
        out.append((h, len(w), sum(x in uni for x in w), total, base, score))
    return out, prob, list(uni), after


def check(df, order=katz.ORDER):
    rows = df.select("doc_id", "text").collect()
    held = [r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in rows]
    expect, prob, uni, after = brute([r["text"] for r in rows], held, order)
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[6])
    got = sorted((tuple(r)[:7] for r in katz.score(df, katz.HELD_OUT.format(id="doc_id"), order=order).collect()), key=key)
    want = sorted(((r["doc_id"], *e) for r, e in zip(rows, expect)), key=key)
    assert [g[:5] for g in got] == [w[:5] for w in want]
    assert np.allclose([g[5:] for g in got], [w[5:] for w in want], rtol=1e-9, atol=1e-6)
    return expect, prob, uni, after


@pytest.mark.parametrize("order, chunk", [(1, 4000), (2, 4000), (3, 1_500_000), (3, 3000), (4, 5000)])
def test_op7(spark, documents, monkeypatch, order, chunk):
    monkeypatch.setattr(katz, "CHUNK_TOKENS", chunk)
    df = documents if order != 3 else documents.where("length(text) < 3000")
    expect, prob, uni, after = check(df.limit(80), order)
    for k in range(order):  # every history's distribution sums to 1, at each order
        some = sorted(h for h in after if len(h) == k)
        for h in some[:: max(1, len(some) // 8)] + [(b" ",) * k, (b"never seen",) * k]:
            assert abs(sum(prob(h, w) for w in uni) + prob(h, b"no such word") - 1) < 1e-9
    if order > 1:
        assert sum(e[5] for e in expect if e[0]) > sum(e[4] for e in expect if e[0])  # better than the base on held-out texts


def test_op7_rows(documents):
    out = katz.op7_katz_scoring(documents).collect()
    assert len(out) == documents.count() and {r["discounts"].count(",") for r in out} == {katz.ORDER - 1}
    assert sorted(map(str, out)) == sorted(map(str, katz.op7_katz_scoring(documents).collect()))


def test_discounts():
    d, how = katz.discounts([1000, 300, 120, 60, 40, 25])
    assert how == "good-turing" and all(0 < x < 1 for x in d[1:])
    for n in ([0] * 6, [5, 0, 0, 0, 0, 0], [1, 5, 9, 9, 9, 9]):
        d, how = katz.discounts(n)
        assert how == "absolute" and d[0] == 1.0 and all(0 < x < 1 for x in d[1:])


def test_op7_odd(spark, odd, none):
    check(odd)
    assert katz.op7_katz_scoring(none).count() == 0
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    check(spark.createDataFrame([(i, "a b") for i in held], "doc_id long, text string"))


# mixing


def plain_targets(sizes):
    """The rule word for word: share by weight, cut what is above twice its size, share the excess again."""
    order = sorted(sizes, key=lambda x: (x is None, (x or "").encode()))
    weight = {x: (5, 2, 1)[i % 3] for i, x in enumerate(order)}
    goal, open_, left = dict.fromkeys(order, 0.0), set(order), 1.5 * sum(sizes.values())
    while open_:
        share = {x: left * weight[x] / sum(weight[y] for y in open_) for x in open_}
        over = {x for x in open_ if share[x] > 2 * sizes[x]}
        if not over:
            return goal | share
        for x in over:
            goal[x] = 2.0 * sizes[x]
            left -= goal[x]
        open_ -= over
    return goal


def test_mixing_ranges_are_even_whatever_the_weights(spark):
    """Sources whose documents fail none, three or four rules, one of copies of one row: no range is much over its size."""
    u = (F.xxhash64("id").bitwiseAND((1 << 52) - 1).cast("double") + 0.5) / float(1 << 52)
    rows = spark.range(60_000).select(F.col("id").alias("_n"), "id", F.element_at(F.array(*map(F.lit, ["a", "b", "c", None])), (F.col("id") % 4 + 1).cast("int")).alias("_src"), F.lit(1).alias("_size"), u.alias("u"))
    weight = F.when(F.col("_src") == "a", 1.0).when(F.col("_src") == "b", 8.0).otherwise(16.0)
    key = F.when(F.col("_src").isNull(), F.lit(0.7)).otherwise(-F.log("u") * weight)
    base = rows.select("_n", F.when(F.col("_src").isNotNull(), F.col("id")).alias("_id"), "_src", "_size", key.alias("_key"))
    sizes = [r["count"] for r in mixing.ranged(base, 4096).groupBy("_src", "_range").count().collect()]
    assert sum(sizes) == 60_000 and max(sizes) <= 3 * 4096


def test_mixing_is_the_same_over_many_ranges(documents):
    once = sorted(map(str, mixing.mix(documents).collect()))
    assert once == sorted(map(str, mixing.mix(documents, range_rows=7).collect()))


@pytest.mark.parametrize("sizes", [{"b": 100, "a": 100, None: 100, "c": 1000}, {"a": 8, "b": 8, "c": 8}, {"a": 0}, {"é": 3, "z": 50, "Z": 7, "": 1, None: 0, "zz": 900}])
def test_targets(spark, sizes):
    got = {r["source"]: r["target"] for r in mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, n long")).collect()}
    assert got == pytest.approx(plain_targets(sizes))
    assert mixing.targets(spark.createDataFrame([], "source string, n long")).count() == 0


def test_weights_follow_quality(spark):
    """Documents that fail rules are taken later; null ids with different texts have keys of their own."""
    good = [(i, f"good{i} " + "some plain words of a text " * 20, "a", "en") for i in range(200)]
    bad = [(1000 + i, f"bad{i} " + "x#%% y$$$ z*** " * 40, "a", "en") for i in range(200)]
    df = spark.createDataFrame(good + bad, "doc_id long, text string, source string, lang string")
    out = {r["doc_id"]: r["copies"] for r in mixing.op10_source_mixing(df).collect()}
    assert sum(out[i] for i, *_ in good) > 1.2 * sum(out[i] for i, *_ in bad)
    none = spark.createDataFrame([(None, f"text {i}", "a") for i in range(50)], "doc_id long, text string, source string")
    assert mixing._measured(none, 1, None, False, "lang").select("_key").distinct().count() == 50


def test_op10(documents, odd, none):
    for df in (documents, odd):
        out = mixing.op10_source_mixing(df).collect()
        assert len(out) == df.count()
        sums, target, largest = Counter(), {}, Counter()
        by = {r["doc_id"]: r["source"] for r in df.select("doc_id", "source").collect()}
        for r in out:
            s = by[r["doc_id"]]
            sums[s] += r["taken"]
            target[s] = r["target"]
            largest[s] = max(largest[s], r["size"])
            assert 0 <= r["taken"] <= 2 * r["size"] and r["taken"] == r["copies"] * r["size"]
        assert all(abs(sums[s] - target[s]) <= largest[s] for s in target)
        assert sorted(map(str, out)) == sorted(map(str, mixing.op10_source_mixing(df.repartition(3)).collect()))
    assert mixing.op10_source_mixing(none).count() == 0
    assert mixing.mixed(odd).columns == odd.columns


def test_epochs_come_first(spark):
    df = spark.createDataFrame([(i, "w " * 10, "s%d" % (i % 3)) for i in range(90)], "doc_id long, text string, source string")
    out = mixing.op10_source_mixing(df).collect()
    for r in out:
        whole = math.floor(r["target"] / r["source_size"])
        assert r["copies"] in (whole, whole + 1)


# pipeline


def test_pipeline(spark, documents):
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:-1]:
        new = stage(spark, docs, "/root/testdata/sf0.001")
        assert new.columns == documents.columns and [f.dataType for f in new.schema] == [f.dataType for f in documents.schema]
        assert 0 < new.count()
        docs = spark.createDataFrame(new.collect(), documents.schema)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    assert last.count() == docs.count() and "doc_id" in last.columns


def reference_run(docs):
    """All five stages in plain Python over (doc_id, text, lang, source)."""
    import hashlib

    from tokenizers import Tokenizer

    from quireflow.llm import common, quality

    kept = []
    for d in docs:
        m = dict(zip(quality.MEASURES, quality.measure(d[1], d[2])))
        fails = sum(quality.BIT[n] for n, e in quality.RULES if eval(e, {}, m))
        if not fails & quality.POLICIES[quality.PRODUCTION]:
            kept.append(d)
    words = lambda t: [w.lower() for w in t.split()]
    sets = [{tuple(words(d[1])[i : i + 5]) for i in range(len(d[1].split()) - 4)} for d in kept]
    label = list(range(len(kept)))
    find = lambda i: i if label[i] == i else find(label[i])
    for i in range(len(kept)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                label[b] = a
    least = {}
    for i, d in enumerate(kept):
        least[find(i)] = min(least.get(find(i), d), d, key=lambda x: x[0])
    stay = list(least.values())
    seen = Counter()
    for d in stay:
        w = d[1].split()
        seen.update(tuple(w[i : i + 35]) for i in range(len(w) - 34))
    cut = []
    for d in stay:
        w = d[1].split()
        gone = {i + k for i in range(len(w) - 34) if seen[tuple(w[i : i + 35])] > 1 for k in range(35)}
        cut.append((d[0], " ".join(x for i, x in enumerate(w) if i not in gone), d[2], d[3]))
    sizes = Counter()
    for d in cut:
        sizes[d[3]] += len(d[1].split())
    goal = plain_targets(sizes)

    def key(d):
        m = dict(zip(quality.MEASURES, quality.measure(d[1], d[2])))
        k = sum(bool(eval(e, {}, m)) for _, e in quality.RULES)
        digest = hashlib.md5(f"{d[0]}:{hashlib.md5(d[1].encode()).hexdigest()}:{mixing.SEED}".encode()).hexdigest()
        return -math.log((int(digest[:13], 16) + 0.5) / 2**52) * 2**k, d[0]

    library = Tokenizer.from_file(common.tokenizer_path())
    out, run = Counter(), Counter()
    for d in sorted(cut, key=key):
        n, s = len(d[1].split()), d[3]
        epochs = min(goal[s] // sizes[s], 2) if sizes[s] else 0
        run[s] += n
        more = run[s] - n / 2 <= goal[s] - epochs * sizes[s] and epochs < 2
        ids = library.encode(d[1], add_special_tokens=False).ids
        out[d[0], len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()] += int(epochs + more) if n else 0
    return +out


def test_pipeline_is_brute_force(spark, tmp_path):
    """The whole pipeline over a small corpus with copies, near copies, shared passages, junk and several sources."""
    import random

    rng = random.Random(11)
    word = lambda: rng.choice(["the", "of", "and"]) if rng.random() < 0.2 else "w" + "".join(rng.choices("abcdefgh", k=rng.randrange(2, 7)))
    passage = [word() for _ in range(60)]
    docs = []
    for i in range(140):
        w = [word() for _ in range(rng.randrange(30, 260))]
        if i % 9 == 0:
            w[10:10] = passage
        if i % 11 == 0:
            w = [f"{x}###" for x in w]
        docs.append((i, " ".join(w), rng.choice(["en", "de", None]), rng.choice(["s1", "s1", "s2", "s3", None])))
        if i % 7 == 0:
            w[5] = "changed"
            docs.append((1000 + i, " ".join(w), "en", "s1"))
        if i % 10 == 0:
            docs.append((2000 + i, docs[-1][1], "en", "s2"))
    (tmp_path / "sf").mkdir()
    spark.createDataFrame([(*d, len(d[1])) for d in docs], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "sf" / "documents.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path / "sf"))
    got = Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in out.collect())
    want = reference_run(docs)
    assert got == want and 0 < len(want) < len(docs) - 30


def test_pipeline_odd(spark, odd, none):
    from pyspark.sql import functions as F

    shaped = odd.select("doc_id", "text", F.lit("en").alias("lang"), "source", F.length("text").cast("long").alias("n_chars"))
    for df in (shaped, shaped.where("false")):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, df, "").count() >= 0
