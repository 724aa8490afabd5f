"""Joins: diffs, merges, pairing by similarity, quotations, windows around matches, overlaps.

Defined results, unless an operator says otherwise: a null key equals no other key in a join and is one group in
an aggregate; repeated rows give repeated results; other columns of the inputs may have any names.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import arrow as A
from ..functions import text as T
from ..names import free_name
from . import containment


def diff(expected: DataFrame, got: DataFrame, key: str, fields: dict[str, Column] | list[str], order: str | None = None) -> DataFrame:
    """key, issue, and for each field whether it differs: every key of either side that isn't alike on both.

    ``fields`` says what is compared (with ``text.comparable`` where white space and tags don't count). Of
    rows with one key the last in ``order`` holds. A full outer join.
    """
    named = {f: F.col(f) for f in fields} if isinstance(fields, list) else fields

    def side(rows: DataFrame, name: str) -> DataFrame:
        own = rows.select(F.col(key).alias("k"), F.struct(*[c.alias(f) for f, c in named.items()]).alias(name), *([F.col(order).alias("o")] if order else []))
        return own.groupBy("k").agg(F.max_by(name, "o").alias(name)) if order else own

    both = side(expected, "e").withColumn("in_e", F.lit(True)).join(side(got, "g").withColumn("in_g", F.lit(True)), "k", "full_outer")
    issue = F.when(F.col("in_e").isNull(), "extra").when(F.col("in_g").isNull(), "missing")
    changed = [(F.col("in_e").isNotNull() & F.col("in_g").isNotNull() & ~F.col(f"e.{f}").eqNullSafe(F.col(f"g.{f}"))).alias(f"{f}_differs") for f in named]
    out = both.select(F.col("k").alias(key), issue.alias("issue"), *changed)
    return out.where(F.col("issue").isNotNull() | F.greatest(F.lit(False), *[F.col(f"{f}_differs") for f in named]))


def compared(expected: DataFrame, got: DataFrame, key: str, fields: dict[str, Column] | list[str], order: str | None = None) -> DataFrame:
    """One row: questions_compared (keys that both sides have) and questions_with_diffs (rows of ``diff``)."""
    both = expected.select(key).distinct().join(got.select(key).distinct(), key).agg(F.count("*").alias("questions_compared"))
    return both.crossJoin(diff(expected, got, key, fields, order).agg(F.count("*").alias("questions_with_diffs")))  # one row each


def sources_of(unit: Column | dict[str, Column]) -> Column:
    """A unit's sources in an order of their own, for comparison."""
    return F.array_sort(F.transform(F.coalesce(unit["primary_sources"], F.array()), lambda s: F.struct(s["book"].alias("book"), s["chapter"].alias("chapter"), s["verse"].alias("verse"))))


def merged_review(units: DataFrame, review: DataFrame, order: str | None = None) -> DataFrame:
    """Units with a second reading's texts where these are clean, and a list of warnings.

    Both have doc_id, display_number, prompt, options. Options are taken over only if both sides have
    the same four keys; each option's text for itself. Of readings with one number the last in ``order``
    holds, without ``order`` the greatest. The list is the last column, ``warnings`` or a longer name that is free.
    """
    read, own = F.struct("prompt", "options"), free_name(units, "r")
    r = review.groupBy("doc_id", "display_number").agg((F.max_by(read, order) if order else F.max(read)).alias(own))
    j = units.join(r, ["doc_id", "display_number"], "left")
    p, v, b = F.col(f"{own}.prompt"), F.coalesce(f"{own}.options", F.array().cast("array<struct<key:string,text:string>>")), F.col("options")
    keys = lambda o: F.transform(o, lambda x: x["key"])
    same = (F.size(v) == 4) & (F.coalesce(F.size(b), F.lit(0)) == 4) & F.coalesce(keys(v) == keys(b), F.lit(False))
    options = F.when(same, F.zip_with(b, v, lambda x, y: x.withField("text", F.when(T.is_clean(y["text"]), y["text"]).otherwise(x["text"])))).otherwise(b)
    rejected = F.transform(F.filter(v, lambda x: ~T.blank(x["text"]) & ~T.is_clean(x["text"])), lambda x: F.concat(F.lit("vision option "), x["key"], F.lit(" rejected")))
    none = F.array().cast("array<string>")
    warnings = F.when(F.col(own).isNull(), F.array(F.lit("no vision data for this question"))).otherwise(
        F.concat(
            F.when(~T.blank(p) & ~T.is_clean(p), F.array(F.lit("vision prompt rejected (unclean text)"))).otherwise(none),
            F.when(same, rejected).otherwise(F.array(F.lit("vision option shape mismatch; kept baseline"))),
        )
    )
    return j.withColumns({"prompt": F.when(T.is_clean(p), p).otherwise(F.col("prompt")), "options": options, free_name(units, "warnings"): warnings}).drop(own)


def paired(left: DataFrame, right: DataFrame, least: int = 4, share: float = 0.4, gram: int = 4, most: int | None = None) -> DataFrame:
    """left_id, right_id, score, place, n_candidates: right ids ranked for each left one by their longest common substring.

    Both sides have id, core, block (never crossed), year and pos; years that are both known must agree. A score
    under ``least``, or under ``share`` of the shorter core, doesn't count. With ``most`` only so many places are given.
    ``n_candidates`` says how many right ids were compared with the left one.

    A join by prefixes. If the shorter core has m letters, a good pair shares a run of t = max(least, share m) letters,
    hence t - n + 1 of the m - n + 1 places of n-grams in the shorter core; any m - t + 1 of these places have one of the run.
    So the shorter side asks by its m - t + 1 places with the rarest grams only, and the longer answers with all
    its grams; frequent grams are asked for only by cores that have hardly any other. No cross join is made; ``gram``
    may not be over ``least``.
    """
    n = min(gram, least)

    def rows_of(rows: DataFrame) -> DataFrame:
        return rows.select("id", "core", "block", "year", "pos").where(F.length("core") >= least).distinct()

    def side(rows: DataFrame) -> DataFrame:
        """A row for each core of a block and year: copies are compared once."""
        own = rows.select("core", "block", "year").distinct()
        return own.withColumn("k", _core_key()).withColumn("m", F.length("core"))

    def grams(rows: DataFrame) -> DataFrame:
        places = F.transform(F.sequence(F.lit(1), F.col("m") - n + 1), lambda i: F.substring(F.col("core"), i, F.lit(n)))
        return rows.select("block", "k", "m", F.posexplode(places).alias("i", "gram"))

    left_rows, right_rows = rows_of(left), rows_of(right)
    l, r = side(left_rows), side(right_rows)  # noqa: E741
    often = grams(l).unionAll(grams(r)).groupBy("block", "gram").agg(F.count("*").alias("often")).hint("merge")  # small when packed, not when read

    def asked(rows: DataFrame) -> DataFrame:
        rank = F.row_number().over(Window.partitionBy("block", "k").orderBy("often", "i"))
        t = F.greatest(F.lit(least), F.ceil(F.lit(float(share)) * F.col("m")))
        rare = grams(rows).join(often, ["block", "gram"]).withColumn("rank", rank).where(F.col("rank") <= F.col("m") - t + 1)
        return rare.select("block", "gram", "k", "m").distinct()

    def met(short: DataFrame, long: DataFrame, names: list[str], equal: bool) -> DataFrame:
        other = grams(long).select("block", "gram", F.col("k").alias("k2"), F.col("m").alias("m2")).distinct().hint("merge")
        fits = F.col("m") <= F.col("m2") if equal else F.col("m") < F.col("m2")
        return asked(short).join(other, ["block", "gram"]).where(fits).select(F.col("k").alias(names[0]), F.col("k2").alias(names[1]))

    pairs = met(l, r, ["lk", "rk"], True).unionByName(met(r, l, ["rk", "lk"], False)).distinct()
    # a right core stands for its rows: how many, and in order of place so many as may be given
    rows_by_pos = F.array_sort(F.collect_list(F.struct("pos", "id")))
    named = ["block", "core", "year"]
    of_core = right_rows.groupBy(*named).agg((rows_by_pos if most is None else F.slice(rows_by_pos, 1, most)).alias("rows"), F.count("*").alias("n"))
    of_core = of_core.select(_core_key().alias("rk"), F.struct("core", "year", "rows", "n").alias("r"))
    both = pairs.join(l.select(F.col("k").alias("lk"), F.struct("core", "year").alias("l")).hint("merge"), "lk").join(of_core.hint("merge"), "rk")
    years = F.col("l.year").isNull() | F.col("r.year").isNull() | (F.col("l.year") == F.col("r.year"))
    scored = both.where(years).withColumn("score", A.lcs(F.col("l.core"), F.col("r.core")))
    good = (F.col("score") >= least) & (F.col("score") >= share * F.least(F.length("l.core"), F.length("r.core")))
    of_left = Window.partitionBy("lk")
    seen = scored.withColumn("good", good).withColumn("met", F.sum("r.n").over(of_left)).withColumn("no", F.row_number().over(of_left.orderBy(F.col("good").desc(), F.col("score").desc())))
    each = seen.where("good or no = 1").select("lk", "met", "good", "score", F.explode("r.rows").alias("row"))  # one stays for its count
    order = [F.col("good").desc(), F.col("score").desc(), F.col("row.pos")]
    each = each.withColumn("rank", F.row_number().over(of_left.orderBy(*order)))
    each = each if most is None else each.where(F.col("rank") <= most)
    # back to the left rows; an id may have several
    told = left_rows.select("id", _core_key().alias("lk")).join(each.hint("merge"), "lk")
    of_id = Window.partitionBy("id")
    told = told.withColumn("n_candidates", F.sum(F.when(F.col("rank") == 1, F.col("met"))).over(of_id)).withColumn("place", F.row_number().over(of_id.orderBy(*order))).where("good")
    out = told.select(F.col("id").alias("left_id"), F.col("row.id").alias("right_id"), "score", "place", "n_candidates")
    return out if most is None else out.where(F.col("place") <= most)


def _core_key() -> Column:
    return F.md5(F.to_json(F.struct("core", "block", "year")))


def count_guard(n: Column, expected: Column) -> Column:
    """A count is near enough to the one expected: within 2, or 15 % rounded half to even. None isn't."""
    return (n > 0) & (F.abs(n - expected) <= F.greatest(F.lit(2), F.bround(expected.cast("double") * F.lit(0.15).cast("double")).cast("int")))


def first_accepted(candidates: DataFrame) -> DataFrame:
    """left_id, right_id, n: the best placed candidate (left_id, right_id, place, n, expected) that the guard accepts."""
    ok = candidates.where(count_guard(F.col("n"), F.col("expected")))
    best = F.min_by(F.struct("right_id", "n"), "place")
    return ok.groupBy("left_id").agg(best.alias("b")).select("left_id", "b.*")


#: Needles and their characters that an automaton takes, beyond which the index does; characters of each that the automaton holds.
NEEDLES, CHARACTERS, PREFIX = 100_000, 16 << 20, 24


def _finder(texts: list[str]):
    """``texts`` as an automaton over their first ``PREFIX`` characters; each prefix has the numbers of the texts it begins."""
    import ahocorasick

    begins: dict[str, list[int]] = {}
    for i, x in enumerate(texts):
        begins.setdefault(x[:PREFIX], []).append(i)
    out = ahocorasick.Automaton()
    for prefix, numbers in begins.items():
        out.add_word(prefix, (len(prefix), numbers))
    out.make_automaton()
    return out


def _first_places(hay: str, texts: list[str], finder) -> dict[int, int]:
    """The number of each text that ``hay`` contains, with its first place (1 is the start)."""
    found: dict[int, int] = {}
    for end, (n, numbers) in finder.iter(hay):
        at = end + 1 - n
        for i in numbers:
            if i not in found and hay.startswith(texts[i], at):
                found[i] = at + 1
    return found


def contained(needles: DataFrame, hays: DataFrame, needle_id: str, hay_id: str, text: str = "text", most: int = NEEDLES, characters: int = CHARACTERS) -> DataFrame:
    """needle_id, hay_id, at: where a needle's text stands in a hay's text first (1 is the start).

    Distinct needles are counted first. Up to ``most`` of them with up to ``characters`` in all, one Arrow pass over
    the hays looks for them with an automaton, which all executors get, and sends only what it finds. Beyond either bound,
    needles are a table like the hays (``containment.located``).

    Every needle row meets every hay row that contains it, repeated and null ids included. Null texts
    and empty needles find nothing.
    """
    n = needles.select(F.col(needle_id).alias("_needle"), F.col(text).alias("_text")).where("_text <> ''")
    h = hays.select(F.col(hay_id).alias("_hay"), F.col(text).alias("_in")).where("_in is not null")
    texts = n.select("_text").distinct()
    count, size = texts.agg(F.count("*"), F.coalesce(F.sum(F.length("_text")), F.lit(0))).first()
    if count > most or size > characters:
        met = containment.located(texts.select(F.col("_text").alias("needle")), h.select(F.col("_hay").alias("hay"), F.col("_in").alias("text")))
        found = met.select(F.col("hay").alias("_hay"), F.col("needle").alias("_text"), "at")
    else:
        found = _by_automaton(texts, h)
    return found.join(n, "_text").select(F.col("_needle").alias(needle_id), F.col("_hay").alias(hay_id), "at")


def _by_automaton(texts: DataFrame, hays: DataFrame) -> DataFrame:
    """(_hay, _text, at) for few texts."""
    wanted = texts.sparkSession.sparkContext.broadcast(sorted(r[0] for r in texts.collect()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = wanted.value
        finder = _finder(own) if own else None
        for b in batches if own else ():
            rows, which, at = [], [], []
            for k, hay in enumerate(b.column(1)):
                for no, place in _first_places(hay.as_py(), own, finder).items():
                    rows.append(k)
                    which.append(own[no])
                    at.append(place)
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(rows, pa.int64())), pa.array(which, pa.string()), pa.array(at, pa.int32())], names=["_hay", "_text", "at"])

    return hays.mapInArrow(run, f"_hay {hays.schema['_hay'].dataType.simpleString()}, _text string, at int")


def window_context(rows: DataFrame, doc: str, pos: str, matched: Column, text: str, before: int = 1, after: int = 1) -> DataFrame:
    """doc, pos, context: the texts of a match and its neighbours, joined by a space. An equi-join on exploded places."""
    m = rows.where(matched).select(F.col(doc).alias("doc"), F.col(pos).alias("pos"), F.explode(F.sequence(F.col(pos) - before, F.col(pos) + after)).alias("near"))
    n = rows.select(F.col(doc).alias("doc"), F.col(pos).alias("near"), F.col(text).alias("text"))
    parts = F.array_sort(F.collect_list(F.struct("near", "text")))
    j = m.join(n, ["doc", "near"]).groupBy("doc", "pos").agg(F.array_join(F.transform(parts, lambda x: x["text"]), " ").alias("context"))
    return j.select(F.col("doc").alias(doc), F.col("pos").alias(pos), "context")


def jaccard(a: Column, b: Column) -> Column:
    """Of two arrays as sets; 0 if either is empty."""
    union = F.size(F.array_union(a, b))
    return F.when((F.size(a) == 0) | (F.size(b) == 0), F.lit(0.0)).otherwise(F.size(F.array_intersect(a, b)) / union)


def tokens(c: Column) -> Column:
    return F.filter(F.split(T.trim(c), T.GAP), lambda x: x != "")


def overlaps(line: Column, field: Column, least: float = 0.5) -> Column:
    """A line belongs to a field: one contains the other, or their words have a Jaccard of ``least``."""
    a, b = T.collapse(T.strip_points(line)), T.collapse(T.strip_points(field))
    return (a != "") & (b.contains(a) | a.contains(b) | (jaccard(tokens(a), tokens(b)) >= least))


def zipped(a: Column, b: Column) -> Column:
    """Pairs of two arrays, as many as the shorter has."""
    n = F.least(F.size(a), F.size(b))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n), lambda x, y: F.struct(x.alias("left"), y.alias("right")))


def unit_sources(qtype: Column, refs: Column, options: Column, correct: Column) -> Column:
    """A unit's sources: of a negative question the n-th reference goes to the n-th wrong option, else to the whole unit."""
    wrong = F.transform(F.filter(options, lambda o: ~o["key"].eqNullSafe(correct)), lambda o: o["key"])
    none = F.lit(None).cast("string")

    def source(r: Column, scope: Column) -> Column:
        return F.struct(r["book"].alias("book"), r["chapter"].alias("chapter"), r["verse"].alias("verse"), none.alias("quoted_text"), scope.alias("scope"))

    by_option = F.transform(zipped(refs, wrong), lambda p: source(p["left"], F.concat(F.lit("answer_option:"), p["right"])))
    whole = F.transform(refs, lambda r: source(r, F.lit("whole_unit")))
    return F.when((qtype == "negative_exclusion") & (F.size(refs) > 0), by_option).otherwise(whole)


def not_yet_done(rows: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Rows whose key hasn't been written: an anti-join."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def underlined(words: DataFrame, rules: DataFrame, cell: float = 20.0) -> DataFrame:
    """Words (doc_id, page_no, word_no, x0, x1, top, bottom) with ``underline``: a thin rule (x0, x1, top) lies under them.

    An interval join: both sides go to cells of the height and meet there, not pair by pair.
    """
    at = ["doc_id", "page_no"]
    low, high = F.floor((F.col("top") - 3) / cell), F.floor((F.col("bottom") + 5) / cell)
    w = words.select(*at, "word_no", F.struct("x0", "x1", "top", "bottom").alias("w"), F.explode(F.sequence(low, high)).alias("cell"))
    r = rules.select(*at, F.struct("x0", "x1", "top").alias("r"), F.floor(F.col("top") / cell).alias("cell"))
    under = (F.col("r.x0") <= F.col("w.x1") + 1) & (F.col("r.x1") >= F.col("w.x0") - 1) & F.col("r.top").between(F.col("w.top") - 3, F.col("w.bottom") + 5)
    hit = free_name(words, "hit")
    found = w.join(r, [*at, "cell"]).where(under).select(*at, "word_no").distinct().withColumn(hit, F.lit(True))
    return words.join(found, [*at, "word_no"], "left").withColumn(free_name(words, "underline"), F.coalesce(hit, F.lit(False))).drop(hit)


def thin_rules(shapes: DataFrame) -> DataFrame:
    """Rectangles and lines at most 3 high and at least 3 wide, which can underline a word."""
    return shapes.where((F.col("bottom") - F.col("top") <= 3) & (F.col("x1") - F.col("x0") >= 3)).select("doc_id", "page_no", "x0", "x1", "top")


def without_page_numbers(chars: DataFrame, words: DataFrame, pages: DataFrame) -> DataFrame:
    """Characters whose middle isn't inside a bare number of up to three digits in the top 7 % or bottom 8 % of its page."""
    sized = words.select("doc_id", "page_no", "text", "x0", "x1", "top", "bottom").join(pages.select("doc_id", "page_no", "height"), ["doc_id", "page_no"])
    band = (F.col("bottom") > F.col("height") * 0.92) | (F.col("top") < F.col("height") * 0.07)
    boxes = sized.where(F.col("text").rlike(r"(?U)^\d{1,3}$") & band).select("doc_id", "page_no", "x0", "x1", "top", "bottom")
    c, b = chars.alias("c"), boxes.alias("b")
    cx, cy = (F.col("c.x0") + F.col("c.x1")) / 2, (F.col("c.top") + F.col("c.bottom")) / 2
    on = (F.col("c.doc_id") == F.col("b.doc_id")) & (F.col("c.page_no") == F.col("b.page_no")) & cx.between(F.col("b.x0"), F.col("b.x1")) & cy.between(F.col("b.top"), F.col("b.bottom"))
    return c.join(b, on, "left_anti")
