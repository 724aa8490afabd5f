"""Text operators as Column expressions: all of them run inside the JVM.

Java's ``\\s`` and ``\\d`` are ASCII only; patterns that need all white space carry ``(?U)``.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import constants as C

SPACE = r"(?U)\s"
GAP = r"(?U)\s+"
#: The characters of ``(?U)\s``.
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
TAG = r"</?([a-zA-Z][a-zA-Z0-9]*)(?U)\s*>"


def lookup(table: dict, key: Column) -> Column:
    """The table's value for ``key``, null if it has none."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in table.items() for x in kv]), key)


def blank(c: Column) -> Column:
    """True for null and the empty string alike."""
    return F.coalesce(c, F.lit("")) == ""


def let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of ``value``, which is evaluated once however often ``f`` has it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def number_of(c: Column) -> Column:
    """A text of up to nine digits as an int, null for any other text."""
    return F.when(c.rlike("^[0-9]{1,9}$"), c.cast("int"))


def trim(c: Column) -> Column:
    return F.btrim(c, F.lit(WHITE))


def collapse(c: Column) -> Column:
    return trim(F.regexp_replace(c, GAP, " "))


def matches(c: Column, pattern: str) -> Column:
    return F.coalesce(c, F.lit("")).rlike(pattern)


def count_chars(c: Column, char_class: str) -> Column:
    """How many characters of ``c`` are in the class (the inside of brackets)."""
    return F.length(F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{char_class}]", ""))


# letters and numbers


def letter_sum(c: Column, values: dict[str, int] = C.LETTER_VALUES) -> Column:
    """The sum of the letters' values; other characters count nothing."""
    chars = F.split(F.coalesce(c, F.lit("")), "")
    return F.aggregate(F.transform(chars, lambda x: F.coalesce(lookup(values, x), F.lit(0))), F.lit(0), lambda a, x: a + x)


def numeral(n: Column) -> Column:
    """Letters for a number: hundreds up to 400, tens, ones; 15 and 16 take 9 + 6 and 9 + 7; nothing for n <= 0."""
    by_value = {v: k for k, v in C.LETTER_VALUES.items() if k not in C.FINAL_LETTERS}

    def digit(value: Column, unit: int) -> Column:
        return F.coalesce(lookup(by_value, (value * unit).cast("int")), F.lit(""))

    hundreds, rest = F.floor(n / 100), n % 100
    low = F.when(rest.isin(15, 16), F.concat(F.lit(by_value[9]), digit(rest - 9, 1))).otherwise(F.concat(digit(F.floor(rest / 10), 10), digit(rest % 10, 1)))
    return F.when(n <= 0, "").otherwise(F.concat(digit(hundreds, 100), low))


def letter_count(c: Column) -> Column:
    return count_chars(c, "\\u0590-\\u05EA")


def readable(c: Column, least: int = 40) -> Column:
    return letter_count(c) >= least


# points, skeletons, marks


def strip_points(c: Column) -> Column:
    return F.regexp_replace(c, f"[{C.POINTS}]", "")


def skeleton(c: Column) -> Column:
    """Letters only, final forms folded. The text must be in compatibility form (see ``arrow.nfkc``)."""
    return F.translate(F.regexp_replace(F.coalesce(c, F.lit("")), f"[^{C.LETTERS}]", ""), C.FINAL_LETTERS, C.PLAIN_LETTERS)


def bare_name(word: Column) -> Column:
    """A word without the punctuation that may surround a short form of the Name."""
    return F.regexp_replace(word, "^[\"“”.,()\\[\\]]+|[\"“”.,()\\[\\]]+$", "")


def quote_stream(c: Column) -> Column:
    """The skeleton of a quotation in which the short forms of the Name stand for its letters."""
    words = F.split(trim(c), GAP)
    return F.array_join(F.transform(words, lambda w: F.when(bare_name(w).isin(C.NAME_SHORT), C.NAME_FULL).otherwise(skeleton(w))), "")


def is_vocalized(word: Column) -> Column:
    return word.rlike(f"[{C.POINTS}{C.LOST}]")


def has_vowels(line: Column) -> Column:
    return count_chars(line, C.VOWELS) >= 2


def detached_or_lost(c: Column) -> Column:
    """A mark after white space, or the character for lost ones."""
    return F.coalesce(c.rlike(f"(?U)\\s[{C.POINTS}]|{C.LOST}"), F.lit(False))


def is_clean(c: Column) -> Column:
    return ~blank(c) & ~detached_or_lost(c)


def ends_with_furniture(c: Column) -> Column:
    """A number of up to three digits after a letter at the end: a page number that leaked into the text."""
    return matches(trim(c), f"[{C.LETTERS}](?U)\\s+\\d{{1,3}}\\s*$")


def turned(c: Column) -> Column:
    """A line that was drawn from right to left, in reading order: a letter keeps its marks, digits keep their order.

    Null gives null. The result isn't normalised yet (``arrow.logical`` is this in composed form).
    """
    clusters = F.regexp_extract_all(c, F.lit(f"(?U)\\s|\\S[{C.POINTS}]*"), 0)
    back = F.array_join(F.reverse(clusters), "")
    runs = F.regexp_extract_all(back, F.lit(r"(?U)\d+|\D+"), 0)
    return F.array_join(F.transform(runs, lambda r: F.when(r.rlike(r"(?U)^\d"), F.reverse(r)).otherwise(r)), "")


def clean_points(c: Column) -> Column:
    return collapse(F.regexp_replace(F.coalesce(c, F.lit("")), "[\\u05C3\\u05C0\\u05C6\\u05F3\\u05F4]", ""))


def clean_verse(c: Column) -> Column:
    """A verse without tags, section marks and cantillation; the hyphen becomes a space. Entities go first (``arrow.unescaped``)."""
    s = F.regexp_replace(c, "[{(\\[][ספ]?[})\\]]", "")
    s = F.regexp_replace(s, "[\\u0591-\\u05AF\\u05BD\\u05BF\\u05C0\\u05C3-\\u05C6]", "")
    return collapse(F.regexp_replace(s, "\\u05BE", " "))


def clean_question(c: Column) -> Column:
    """One question mark at the end, nothing loose before it; an empty text stays empty."""
    loose = '(?U)[\\s:"“”׳״,\\-]'
    s = F.regexp_replace(trim(c), r"(?U)\s{2,}", " ")
    s = F.regexp_replace(s, loose + "*\\?+\\s*$", "")
    s = trim(F.regexp_replace(s, loose + "+$", ""))
    return F.when(s == "", s).otherwise(F.concat(s, F.lit("?")))


# emphasis tags


def strip_tags(c: Column) -> Column:
    return F.regexp_replace(F.coalesce(c, F.lit("")), TAG, "")


def has_tags(c: Column) -> Column:
    return matches(c, TAG)


def tag_errors(c: Column) -> Column:
    """Errors of a text's tags: only b, u, i, and each closed in order. A fold over the tags with a stack."""
    tags = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit("(" + TAG + ")"), 1)
    start = F.struct(F.array().cast("array<string>").alias("open"), F.array().cast("array<string>").alias("errors"))

    def step(a: Column, t: Column) -> Column:
        name = F.lower(F.regexp_extract(t, TAG, 1))
        top = F.when(F.size(a["open"]) > 0, F.element_at(a["open"], -1))
        known, closing = name.isin(C.TAGS), t.startswith("</")
        fits = F.coalesce(top == name, F.lit(False))
        opened = F.when(~known, a["open"]).when(~closing, F.array_append(a["open"], name)).when(fits, F.slice(a["open"], F.lit(1), F.size(a["open"]) - 1)).otherwise(a["open"])
        error = F.when(~known, F.concat(F.lit("disallowed tag <"), name, F.lit(">"))).when(closing & ~fits, F.concat(F.lit("unbalanced </"), name, F.lit(">")))
        return F.struct(opened.alias("open"), F.array_compact(F.array_append(a["errors"], error)).alias("errors"))

    def end(a: Column) -> Column:
        rest = F.when(F.size(a["open"]) > 0, F.concat(F.lit("unclosed tags: "), F.array_join(a["open"], ", ")))
        return F.array_compact(F.array_append(a["errors"], rest))

    return F.aggregate(tags, start, step, end)


def sanitize(c: Column) -> Column:
    return F.when(F.size(tag_errors(c)) == 0, c).otherwise(strip_tags(c))


def comparable(c: Column) -> Column:
    """Text without tags, white space collapsed."""
    return collapse(strip_tags(c))


# ids


def decode_id(base: Column) -> Column:
    """track, stage, year and age group that an id tells; what it can't tell is null. Overrides win."""
    low = F.lower(base)
    stage = reduce(lambda rest, p: F.when(low.contains(p[0]), p[1]).otherwise(rest), reversed(C.STAGE_PARTS), F.lit(None).cast("string"))

    def marked(track: str) -> Column:
        return low.rlike(r"(^|[_\-])(" + "|".join(C.TRACK_MARKS[track]) + r")($|[_\-]|\d)")

    track = reduce(lambda rest, t: F.when(marked(t), t).otherwise(rest), reversed(list(C.TRACK_MARKS)), F.lit(None).cast("string"))
    year = F.regexp_extract(base, r"(20\d{2})", 1)
    age = F.when(low.rlike("|".join(C.ADULT_PARTS)), "adult").when(stage.isNotNull(), "youth")
    parts = {"track": track, "stage": stage, "year_civil": F.when(year != "", year.cast("int")), "age_group": age}
    out = []
    for i, (name, value) in enumerate(parts.items()):
        fixed = {k: v[i] for k, v in C.ID_OVERRIDES.items() if v[i] is not None}
        out.append(F.coalesce(lookup(fixed, base), value).alias(name))
    return F.struct(*out)


def hebrew_year(year: Column) -> Column:
    return lookup(C.HEBREW_YEARS, year)


def is_dati(base: Column) -> Column:
    return F.lower(base).rlike(C.DATI_MARKS)


def id_core(base: Column) -> Column:
    """The id without marks of answer keys and anything but letters and digits."""
    return F.regexp_replace(F.regexp_replace(F.lower(base), C.ANSWER_MARKS, ""), f"[^a-z0-9{C.LETTERS}]", "")


# source references

_LONGEST_FIRST = sorted(C.BOOKS, key=len, reverse=True)
_BOOK = "^(" + "|".join(_LONGEST_FIRST) + ")"
_SHORT = f"^([{C.LETTERS}]+)[\"'׳״]([{C.LETTERS}])"
_QUOTES = "\"'׳״"


def _stripped(c: Column, chars: str) -> Column:
    return F.regexp_replace(c, f"^[{chars}]+|[{chars}]+$", "")


def book_of(segment: Column) -> Column:
    """The book that a segment starts with, by its name or a known abbreviation."""
    full = F.regexp_extract(segment, _BOOK, 1)
    short = F.concat(F.regexp_extract(segment, _SHORT, 1), F.regexp_extract(segment, _SHORT, 2))
    return F.when(full != "", full).otherwise(lookup(C.BOOK_ABBREVIATIONS, short))


def _booked(segment: Column) -> Column:
    """(book, rest) of a segment: the book that it starts with and what follows; each pattern is tried once."""
    short = lambda: F.concat(F.regexp_extract(segment, _SHORT, 1), F.regexp_extract(segment, _SHORT, 2))

    def told(full: Column, book: Column) -> Column:
        rest = F.when(full != "", trim(F.regexp_replace(segment, _BOOK, ""))).when(book.isNotNull(), trim(F.regexp_replace(segment, _SHORT, ""))).otherwise(segment)
        return F.struct(book.alias("book"), rest.alias("rest"))

    return let(F.regexp_extract(segment, _BOOK, 1), lambda full: let(F.when(full != "", full).otherwise(lookup(C.BOOK_ABBREVIATIONS, short())), lambda book: told(full, book)))


def after_book(segment: Column) -> Column:
    return _booked(segment)["rest"]


def looks_like_source(c: Column) -> Column:
    return matches(c, "|".join(_LONGEST_FIRST)) | matches(trim(c), _SHORT)


def verse_letters(v: Column) -> Column:
    """A verse or a range in letters: digits become letters, smallest first."""
    own = F.filter(F.transform(F.split(trim(v), r"(?U)\s*[-–]\s*"), lambda p: _stripped(p, _QUOTES + " ")), lambda p: p != "")

    def told(parts: Column) -> Column:
        digits = F.forall(parts, lambda p: p.rlike(r"^\d+$"))
        sorted_ = F.transform(F.array_sort(F.transform(F.filter(parts, lambda p: p.rlike(r"^\d+$")), lambda p: p.cast("int"))), numeral)
        return F.array_join(F.when(digits, sorted_).otherwise(parts), "-")

    return let(own, told)


_TOKEN = f"[{C.LETTERS}{_QUOTES}]"
_VERSE = f"[0-9{C.LETTERS}{_QUOTES}]+"
_CHAPTER_VERSE = f"(?U)^({_TOKEN}+)\\s*,\\s*({_VERSE}(?:\\s*[-–]\\s*{_VERSE})?)"


def source_refs(c: Column) -> Column:
    """``book chapter, verse; chapter, verse; ...`` as an array of references; a book holds until the next one."""
    segments = F.transform(F.split(F.coalesce(c, F.lit("")), ";"), lambda s: _stripped(trim(s), "."))
    kind = "array<struct<book:string,chapter:string,verse:string>>"
    start = F.struct(F.lit(None).cast("string").alias("book"), F.array().cast(kind).alias("refs"))

    def step(a: Column, s: Column) -> Column:
        return let(_booked(s), lambda v: let(F.struct(F.coalesce(v["book"], a["book"]).alias("book"), v["rest"].alias("rest"), F.regexp_extract(v["rest"], _CHAPTER_VERSE, 1).alias("pair")), lambda v: read(a, s, v)))

    def read(a: Column, s: Column, v: Column) -> Column:
        book, rest, pair = v["book"], v["rest"], v["pair"]
        whole = F.struct(book.alias("book"), _stripped(pair, _QUOTES).alias("chapter"), verse_letters(F.regexp_extract(rest, _CHAPTER_VERSE, 2)).alias("verse"))
        chapter = _stripped(F.split(rest, GAP)[0], _QUOTES + ",")
        bare = F.struct(book.alias("book"), chapter.alias("chapter"), F.lit(None).cast("string").alias("verse"))
        ref = F.when(book.isNotNull() & (s != ""), F.when(pair != "", whole).when(rest.rlike(f"^[{C.LETTERS}]"), bare))
        return F.struct(book.alias("book"), F.array_compact(F.array_append(a["refs"], ref)).alias("refs"))

    return F.aggregate(segments, start, step, lambda a: a["refs"])


def english_ref(ref: Column) -> Column:
    """``Book 3:4-5`` for a reference struct; null for an unknown book or chapter."""
    book, chapter = lookup(C.BOOKS, trim(F.coalesce(ref["book"], F.lit("")))), letter_sum(ref["chapter"])
    ends = F.transform(F.split(F.coalesce(ref["verse"], F.lit("")), "[-\\u05BE]"), lambda p: letter_sum(p))
    first, second = ends[0], F.coalesce(F.get(ends, F.lit(1)), F.lit(0))
    verse = F.when(first > 0, F.concat(F.lit(":"), first.cast("string"), F.when(second > 0, F.concat(F.lit("-"), second.cast("string"))).otherwise(""))).otherwise("")
    return F.when(book.isNotNull() & (chapter > 0), F.concat(book, F.lit(" "), chapter.cast("string"), verse))


def widened(ref: Column, before: int = 2, after: int = 1) -> Column:
    """The reference with its verse as a range around it; a range or name sums its letters; none stays."""
    v = letter_sum(ref["verse"])
    around = F.concat(numeral(F.greatest(F.lit(1), v - before)), F.lit("-"), numeral(v + after))
    return F.when(v > 0, ref.withField("verse", around)).otherwise(ref)


# questions


def question_type(prompt: Column, options: Column) -> Column:
    """The first that holds of: numeric options, who spoke, what doesn't; else multiple choice."""
    own = F.coalesce(options, F.array().cast("array<struct<key:string,text:string>>"))
    numeric = (F.size(own) > 0) & F.forall(own, lambda o: trim(o["text"]).rlike(r"(?U)^\d+$"))
    opening = matches(prompt, "(?U)^(" + "|".join(C.QUESTION_OPENINGS) + r")\b")
    negative = matches(prompt, f"(?U)(^|\\s){C.NOT_WORD}(\\s|$)") & opening
    speaker = matches(prompt, "|".join(C.SPEAKER_PHRASES))
    return F.when(numeric, "numeric").when(speaker, "speaker_id").when(negative, "negative_exclusion").otherwise("multiple_choice")


def longest_quoted(c: Column) -> Column:
    """(at, text) of the longest text in quotation marks, the first of equals; null if there is none."""
    spans = F.regexp_extract_all(F.coalesce(c, F.lit("")), F.lit('"([^"]+)"'), 1)
    return F.array_max(F.transform(spans, lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("i"), s.alias("text"))))["text"]


def narrative_split(prompt: Column) -> Column:
    """(narrative, question): a quoted verse (two vocalised words or more), else three or more vocalised words in a row."""
    p = F.coalesce(prompt, F.lit(""))
    spans = F.transform(F.regexp_extract_all(p, F.lit('"([^"]+)"'), 1), lambda s, i: F.struct(F.length(s).alias("n"), (-i).alias("i"), s.alias("text")))
    good = F.filter(spans, lambda s: F.size(F.filter(F.split(s["text"], GAP), is_vocalized)) >= 2)
    best = F.array_max(good)["text"]
    at = F.instr(p, F.concat(F.lit('"'), best, F.lit('"')))
    around = F.concat(F.substring(p, F.lit(1), at - 1), F.lit(" "), F.substring(p, at + F.length(best) + 2, F.length(p)))
    words = F.filter(F.split(trim(p), GAP), lambda w: w != "")
    kind = "struct<best:struct<n:int,start:int>,run:int,i:int>"
    runs = F.aggregate(
        words,
        F.expr("named_struct('best', named_struct('n', 0, 'start', 0), 'run', 0, 'i', 0)").cast(kind),
        lambda a, w: _run_step(a, is_vocalized(w)).cast(kind),
    )["best"]
    run = F.array_join(F.slice(words, runs["start"] + 1, runs["n"]), " ")
    left = F.array_join(F.concat(F.slice(words, F.lit(1), runs["start"]), F.slice(words, runs["start"] + runs["n"] + 1, F.size(words))), " ")
    plain = trim(p)

    def result(verse: Column, rest: Column) -> Column:
        question = clean_question(rest)
        return F.struct(F.when(verse != "", verse).alias("narrative"), F.when(question == "", plain).otherwise(question).alias("question"))

    quoted = result(trim(_stripped(trim(best), "“”")), around)
    long_run = result(trim(_stripped(run, '"“”')), left)
    none = F.struct(F.lit(None).cast("string").alias("narrative"), plain.alias("question"))
    # without a mark there is no vocalised word, quoted or not
    return F.when(~is_vocalized(p), none).when(best.isNotNull(), quoted).when(runs["n"] >= 3, long_run).otherwise(none)


def _run_step(a: Column, vocalized: Column) -> Column:
    run = F.when(vocalized, a["run"] + 1).otherwise(0)
    better = run > a["best"]["n"]
    best = F.when(better, F.struct(run.cast("int").alias("n"), (a["i"] - run + 1).cast("int").alias("start"))).otherwise(a["best"])
    return F.struct(best.alias("best"), run.alias("run"), (a["i"] + 1).alias("i"))


def alternates(answer: Column) -> Column:
    """(primary, alternates, note) of an answer with a clause of what is accepted as well, or a remark in parentheses."""
    a = F.coalesce(answer, F.lit(""))
    clause = C.ALTERNATES_CLAUSE
    found = F.regexp_extract(a, clause, 1)
    body = lambda s: trim(F.regexp_extract(s, r"(?s)^([^(]*)", 1))
    before = trim(F.regexp_replace(trim(F.regexp_replace(a, "(?s)" + clause + ".*$", "")), r"\(+$", ""))
    others = F.filter(F.transform(F.split(F.regexp_replace(found, r"[) ]+$", ""), r"(?U)\s*[/;]\s*"), trim), lambda x: x != "")
    remark = F.regexp_extract(a, r"(?s)(\(.*)$", 1)
    note = F.when((remark != "") & ~looks_like_source(remark), trim(remark))
    empty = F.array().cast("array<string>")
    return F.when(found != "", F.struct(body(before).alias("primary"), others.alias("alternates"), F.lit(None).cast("string").alias("note"))).otherwise(
        F.struct(body(a).alias("primary"), empty.alias("alternates"), note.alias("note"))
    )


def live_rules(c: Column) -> Column:
    """points per correct answer, points lost for a hint, seconds allowed: the first of each in the regulations' text."""
    s = strip_points(c)

    def number(pattern: str) -> Column:
        return F.when(s.rlike(pattern), F.regexp_extract(s, pattern, 1).cast("int"))

    rules = F.struct(
        number(C.RULE_POINTS).alias("points_per_correct"),
        number(C.RULE_HINT).alias("points_decay_per_hint"),
        number(C.RULE_SECONDS).alias("time_limit_seconds"),
    )
    any_ = rules["points_per_correct"].isNotNull() | rules["points_decay_per_hint"].isNotNull() | rules["time_limit_seconds"].isNotNull()
    return F.when(any_, rules)


def cover_page(c: Column) -> Column:
    """What a cover page tells: minutes, supervisor, coordinator, authors."""
    s = strip_points(c)

    def label(name: str) -> Column:
        found = F.regexp_extract(s, f"(?U){name}[:\\s]+([{C.LETTERS}\"' ]+?)(?:\\n|$)", 1)
        return F.when(found != "", trim(found))

    minutes = F.regexp_extract(s, f"(?U){C.COVER_MINUTES}[:\\s]*?(\\d+)", 1)
    authors = F.split(label(C.COVER_AUTHORS), f"(?U)\\s*,\\s*|\\s+ו(?=[{C.LETTERS}])")
    names = F.filter(F.transform(authors, trim), lambda x: x != "")
    return F.struct(
        F.when(minutes != "", minutes.cast("int")).alias("time_limit_minutes"),
        label(C.COVER_SUPERVISOR).alias("program_supervisor"),
        label(C.COVER_COORDINATOR).alias("quiz_coordinator"),
        F.coalesce(names, F.array().cast("array<string>")).alias("question_authors"),
    )


def looks_staged(pages: Column) -> Column:
    """Pages of a staged booklet: stages after the first, answers in place, and a name of a staged round."""
    t = F.array_join(pages, "\n")
    return t.rlike(C.LATER_STAGE) & (t.contains(C.THE_ANSWER_MARK) | t.contains(C.ANSWERS_MARK)) & t.rlike("(?U)" + C.BOOKLET_STAGES)


def stage_subtype(name: Column, lines: Column) -> Column:
    named = reduce(lambda rest, kv: F.when(name.contains(kv[0]), kv[1]).otherwise(rest), reversed(list(C.SUBTYPES.items())), F.lit(None).cast("string"))
    crossword = F.exists(lines, lambda x: x.rlike(C.CROSSWORD_LINE))
    pairs = F.exists(lines, lambda x: x.rlike(C.PAIR_LINE))
    return F.coalesce(named, F.when(crossword, "crossword").when(pairs, "head-to-head").otherwise("live-rounds"))


def rejoined(cell: Column, sep: str) -> Column:
    """The lines of a table cell in reading order: they come out last first."""
    return F.array_join(F.reverse(F.filter(F.split(cell, "\n"), lambda x: trim(x) != "")), sep)
