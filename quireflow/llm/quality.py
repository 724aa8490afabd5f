"""Quality rules as a ledger of failure bits: every rule is evaluated once for a document.

``ledger`` measures a document once and has the measurements and one bit for each rule that it fails;
``write_ledger`` stores it under the version of the rules. ``POLICIES`` are versioned masks over these bits: a
policy's verdict (``judged``), and what each rule alone adds to it (``ablations``), come from the stored bits
with no second look at the texts.

Rules beyond the base are of the kinds known from public web corpora: shape of words and characters,
shape of lines, repetition, and stop words by language. All thresholds are in ``RULES``.

Defined results: a null or empty text has no words and fails ``few_words``. Texts are measured whole. A
language without a list of stop words (or null) measures -1 of them and never fails that rule. Repeated rows are
measured each for itself. Other columns pass through ``apply_policy`` untouched, whatever their names.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch
from .common import free_name

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
_UPPER, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_SYMBOL_BYTES, _SPACE_BYTES = SYMBOLS.encode(), SPACES.encode()
#: A word without a letter: no A-Z, a-z, or byte of another script.
_BARE = re.compile(rb"(?<![^ \t-\r])[^A-Za-z\x80-\xff \t-\r]+(?![^ \t-\r])")
#: Frequent words that a text of a language has.
STOP_WORDS = {
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "ist"],
    "en": ["the", "be", "to", "of", "and", "that", "have", "with", "in", "is"],
    "es": ["de", "la", "que", "el", "en", "y", "los", "un", "por", "con"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "que", "une"],
}
_STOP = {lang: {w.encode() for w in words} for lang, words in STOP_WORDS.items()}

MEASURES = [
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_bare_words", "n_digits", "n_upper", "n_ellipsis_lines", "n_bullet_lines", "longest_word", "n_top_pair", "n_stop_words",
]

#: The version of the rules and measurements below; a stored ledger is kept under it.
RULE_SET = 2
#: (name, a document fails where this holds over its measurements); a rule's bit is its position, so rules are only added at the end.
RULES: list[tuple[str, str]] = [
    ("few_words", "n_words < 50"),
    ("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    ("symbols", "10 * n_symbols > n_words"),
    ("word_length", "word_chars < 2 * n_words or word_chars > 15 * n_words"),
    ("duplicate_lines", "n_lines >= 4 and 10 * n_dup_lines > 5 * n_lines"),
    ("bare_words", "n_words >= 50 and 100 * n_bare_words > 20 * n_words"),
    ("digits", "n_words >= 50 and 100 * n_digits > 20 * word_chars"),
    ("capitals", "n_words >= 50 and 100 * n_upper > 40 * word_chars"),
    ("ellipsis_lines", "n_lines >= 4 and 100 * n_ellipsis_lines > 30 * n_lines"),
    ("bullet_lines", "n_lines >= 4 and 100 * n_bullet_lines > 90 * n_lines"),
    ("longest_word", "longest_word > 1000"),
    ("top_pair", "n_words >= 50 and 100 * n_top_pair > 20 * n_words"),
    ("stop_words", "n_words >= 50 and n_stop_words >= 0 and n_stop_words < 2"),
]
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}
BASE = BIT["few_words"] | BIT["repeated_windows"]
#: A policy is the mask of the rules that reject a document.
POLICIES: dict[str, int] = {
    "v1": BASE,
    "v2": BASE | BIT["symbols"] | BIT["word_length"] | BIT["duplicate_lines"],
    "v3": (1 << len(RULES)) - 1,
}
PRODUCTION = "v3"


def measure(text: str | None, lang: str | None = None) -> tuple[int, ...]:
    """The values of ``MEASURES``."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    less = lambda of: len(raw) - len(raw.translate(None, of))
    symbols, stop = less(_SYMBOL_BYTES), _STOP.get(lang) if lang else None
    if not words:
        return (0, 0, symbols, *[0] * (len(MEASURES) - 4), -1 if stop is None else 0)
    top = max(Counter(zip(words, words[1:])).values(), default=0)
    repeated = 0
    if top > 1:  # a window of three that stands twice has pairs that do
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) < len(windows):
            seen, end = Counter(windows), 0
            for i, w in enumerate(windows):
                if seen[w] > 1:
                    repeated += i + 3 - max(i, end)
                    end = i + 3
    lines = [x for x in (y.strip(SPACES) for y in text.split("\n")) if x]
    whole = [x for x in text.split("\n") if x.strip(SPACES)]
    longest = max(map(len, words)) if raw.isascii() else max(map(len, text.translate(_BLANKS).split(" ")))
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        symbols,
        len(lines),
        len(whole) - len(set(whole)),
        repeated,
        len(_BARE.findall(raw)),
        less(_DIGITS),
        less(_UPPER),
        sum(x.endswith(("...", "…")) for x in lines),
        sum(x.startswith(("-", "*", "•", "|")) for x in lines),
        longest,
        2 * top if top > 1 else 0,
        -1 if stop is None else sum(map(stop.__contains__, raw.lower().split())),
    )


_BLANKS = str.maketrans(SPACES, " " * len(SPACES))


def _measure_all(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([measure(t, x) for t, x in zip(texts, langs)], columns=MEASURES)


def _measures(docs: DataFrame, text: str, lang: str | None) -> Column:
    of = F.col(lang).cast("string") if lang and lang in docs.columns else F.lit(None).cast("string")
    return F.pandas_udf(_measure_all, "struct<" + ",".join(f"{m}:bigint" for m in MEASURES) + ">")(F.col(text), of)


def _bits(of: str) -> Column:
    """The failure bits from the measurements in the struct column ``of``."""
    out = F.lit(0)
    for name, fails in RULES:
        for m in MEASURES:
            fails = re.sub(rf"(?<![\w.]){m}(?!\w)", f"`{of}`.{m}", fails)
        out = out.bitwiseOR(F.when(F.expr(fails), BIT[name]).otherwise(0))
    return out


def ledger(docs: DataFrame, keys: tuple[str, ...] = ("doc_id",), text: str = "text", lang: str | None = "lang") -> DataFrame:
    """One row for each row of ``docs``: keys, measurements and ``fail_bits``. ``lang`` is used if ``docs`` has it."""
    measured = docs.select(*keys, _measures(docs, text, lang).alias("_m")).withColumn("fail_bits", _bits("_m"))
    return measured.select(*keys, "_m.*", "fail_bits")


def write_ledger(docs: DataFrame, to: str, keys: tuple[str, ...] = ("doc_id",), text: str = "text", lang: str | None = "lang") -> None:
    """Evaluate the rules and store the ledger in ``to`` under the version of the rules; ledgers of other versions stay."""
    ledger(docs, keys, text, lang).write.mode("overwrite").parquet(f"{to}/rules={RULE_SET}")


def read_ledger(spark: SparkSession, to: str, version: int = RULE_SET) -> DataFrame:
    return spark.read.parquet(f"{to}/rules={version}")


def verdict(bits: Column, policy: str) -> Column:
    return bits.bitwiseAND(POLICIES[policy]) == 0


def judged(rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """A stored ledger's rows with ``base_failed`` and ``kept``."""
    bits = F.col("fail_bits")
    return rows.withColumn("base_failed", bits.bitwiseAND(BASE) != 0).withColumn("kept", verdict(bits, policy))


def apply_policy(docs: DataFrame, policy: str = PRODUCTION, text: str = "text", lang: str | None = "lang") -> DataFrame:
    """The rows of ``docs`` that ``policy`` keeps, with their columns. The first look at the texts, so nothing is stored."""
    m, b = free_name(docs, "_measures"), free_name(docs, "_bits")
    out = docs.withColumn(m, _measures(docs, text, lang)).withColumn(b, _bits(m))
    return out.where(verdict(F.col(b), policy)).drop(m, b)


def ablations(ledger_rows: DataFrame, policy: str = PRODUCTION) -> DataFrame:
    """For each rule of ``policy``: documents failing it, failing it alone, and kept without it.

    The ledger is first summed by bit pattern (at most 2^rules rows), so no text is read again. An empty ledger has no row.
    """
    mask = POLICIES[policy]
    patterns = ledger_rows.groupBy(F.col("fail_bits").bitwiseAND(mask).alias("b")).agg(F.count("*").alias("n"))
    rules = F.explode(F.array(*[F.struct(F.lit(k).alias("rule"), F.lit(v).alias("bit")) for k, v in BIT.items() if v & mask]))
    each = patterns.select("b", "n", rules.alias("r")).select("b", "n", "r.rule", "r.bit")
    without = F.col("b").bitwiseAND(F.bitwise_not(F.col("bit"))) == 0
    return each.groupBy("rule").agg(
        F.sum(F.when(F.col("b").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failing"),
        F.sum(F.when(F.col("b") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failing_alone"),
        F.sum(F.when(without, F.col("n")).otherwise(0)).alias("n_kept_without"),
    )


def _stored_ledger(docs: DataFrame) -> DataFrame:
    to = scratch(docs.sparkSession, "ledger")
    write_ledger(docs, to)
    return read_ledger(docs.sparkSession, to)


def op9_quality_rules(docs: DataFrame) -> DataFrame:
    rows = judged(_stored_ledger(docs))
    first = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"]
    return rows.select(*first, *[m for m in MEASURES if m not in first], "fail_bits")


def quality_ablations(docs: DataFrame) -> DataFrame:
    """What each rule of the production policy adds, from the stored ledger."""
    return ablations(_stored_ledger(docs))
