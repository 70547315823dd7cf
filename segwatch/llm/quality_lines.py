"""Line-first quality rules: judge each line, drop the failing ones, reject texts that lose too much.

DataFrame functions only. Everything about a document is computed from its own row, so there is no
shuffle and no key that could be hot; a long text is one row of arrays and nothing is cut off it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x09-\x0D\x20]+"
SYMBOLS = "#*$%&|<>"
NGRAM = 5

# What the line rules look for.
ENDINGS = r"[.!?:;…。！？\"'”’»)\]]$"
SEPARATORS = "|›»•·→>"
BOILERPLATE = (
    r"(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|(uses|accept|use) cookies"
    r"|enable javascript|javascript (is|must be) |lorem ipsum|click here|read more|sign (in|up) (to|for)"
    r"|log ?in to|subscribe to|skip to (main )?content|back to top|copyright (©|\(c\)))"
)


@dataclass(frozen=True)
class LineRules:
    """Production parameters of the rules.

    A line is navigation when it has ``min_separators`` separator signs or more and they are at least
    ``separator_share`` of its words. ``min_words`` words without a closing sign fail the punctuation
    rule; shorter lines, such as headings, pass it. A document is rejected when it keeps less than
    ``min_kept`` of the characters of its non-blank lines.
    """

    min_separators: int = 3
    separator_share: float = 0.2
    min_words: int = 12
    min_kept: float = 0.5
    min_document_words: int = 10
    max_repeat_percent: int = 20


def _let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row: a lambda variable is never inlined again."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words_of(text: Column) -> Column:
    """The runs of characters other than space and U+0009 to U+000D; none for NULL."""
    inner = F.btrim(text, F.lit(SPACES))
    return F.when(F.length(inner) > 0, F.split(inner, SPACE_RUN)).otherwise(F.array().cast("array<string>"))


def _count(text: Column, signs: str) -> Column:
    """How many characters of ``text`` are among ``signs``."""
    return F.regexp_count(text, F.lit("[" + re.sub(r"(\W)", r"\\\1", signs) + "]"))


def _repeat_words(words: Column) -> Column:
    """Words inside a window of five that the text holds twice or more."""

    def windows(hashes: Column) -> Column:
        inner = F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - (NGRAM - 1), F.lit(0)))
        return F.transform(inner, lambda h, i: F.xxhash64(h, *(F.get(hashes, i + j) for j in range(1, NGRAM))))

    def covered(grams: Column) -> Column:
        placed = F.array_sort(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        twice = _let(placed, lambda p: F.filter(p, lambda x, i: (
            F.coalesce(F.get(p, i - 1)["g"] == x["g"], F.lit(False)) | F.coalesce(F.get(p, i + 1)["g"] == x["g"], F.lit(False))
        )))
        starts = F.array_sort(F.transform(twice, lambda x: x["i"]))
        steps = _let(starts, lambda s: F.transform(
            s, lambda at, i: F.least(F.lit(NGRAM), F.coalesce(F.get(s, i + 1) - at, F.lit(NGRAM)))
        ))
        return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def count(grams: Column) -> Column:
        nothing = F.size(F.array_distinct(grams)) == F.size(grams)
        return F.when(nothing, F.lit(0).cast("bigint")).otherwise(covered(grams))

    return _let(F.transform(words, lambda w: F.xxhash64(w)), lambda hashes: _let(windows(hashes), count))


def line_fails(line: Column, rules: LineRules = LineRules()) -> Column:
    """True for a line that breaks the punctuation, navigation or boilerplate rule. Blank lines pass."""

    def judged(body: Column, n_words: Column, signs: Column) -> Column:
        navigation = (signs >= rules.min_separators) & (signs >= rules.separator_share * n_words)
        punctuation = (n_words >= rules.min_words) & ~F.rlike(body, F.lit(ENDINGS))
        return (F.length(body) > 0) & (navigation | punctuation | F.rlike(body, F.lit(BOILERPLATE)))

    return _let(F.btrim(line, F.lit(SPACES)), lambda body: _let(
        F.struct(F.size(F.split(body, SPACE_RUN)).alias("words"), _count(body, SEPARATORS).alias("signs")),
        lambda n: judged(body, n["words"], n["signs"]),
    ))


def line_quality(df: DataFrame, text: str = "text", rules: LineRules = LineRules()) -> DataFrame:
    """Add the struct column ``quality`` to ``df``, one row out for each row in, in one narrow stage.

    Fields: ``n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words`` (bigint), ``n_lines``,
    ``n_failed_lines`` (int, non-blank lines), ``base_failed`` (fewer than ten words, or more than a
    fifth of them in repeated windows of five), ``kept`` (neither base_failed nor too much text lost)
    and ``cleaned`` (the text without its failing lines).

    NULL and empty texts have no words, fail the base rule and are cleaned to NULL and the empty text.
    Repeated rows are judged alike, an empty table stays empty, other columns of any name but
    ``quality`` pass through, and an existing ``quality`` is replaced.
    """
    source = F.col(text) if text in df.columns else F.raise_error(F.lit(f"line_quality: no column {text}")).cast("string")
    body = F.coalesce(source, F.lit(""))
    words = words_of(body)
    lines = F.split(body, "\n")

    def described(ws: Column) -> Column:
        return F.struct(
            F.size(ws).cast("bigint").alias("n_words"),
            F.length(F.array_join(ws, "")).cast("bigint").alias("word_chars"),
            _count(body, SYMBOLS).cast("bigint").alias("n_symbols"),
            _repeat_words(ws).alias("n_repeat_words"),
        )

    def judged(ls: Column) -> Column:
        full = F.filter(ls, lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0)
        kept = F.filter(ls, lambda x: ~line_fails(x, rules))
        chars = lambda xs: F.aggregate(xs, F.lit(0).cast("bigint"), lambda n, x: n + F.length(F.btrim(x, F.lit(SPACES))))
        return _let(full, lambda f: F.struct(
            (F.size(f) - F.size(F.array_distinct(f))).cast("bigint").alias("n_dup_lines"),
            F.size(f).alias("n_lines"),
            chars(f).alias("chars"),
            kept.alias("kept_lines"),
        ))

    both = df.withColumn("quality", F.struct(_let(words, described).alias("w"), _let(lines, judged).alias("l")))

    def verdict(w: Column, l: Column) -> Column:  # noqa: E741
        kept_chars = F.aggregate(l["kept_lines"], F.lit(0).cast("bigint"), lambda n, x: n + F.length(F.btrim(x, F.lit(SPACES))))
        kept_lines = F.size(F.filter(l["kept_lines"], lambda x: F.length(F.btrim(x, F.lit(SPACES))) > 0))
        base = (w["n_words"] < rules.min_document_words) | (100 * w["n_repeat_words"] > rules.max_repeat_percent * w["n_words"])
        return F.struct(
            w["n_words"].alias("n_words"), w["word_chars"].alias("word_chars"), w["n_symbols"].alias("n_symbols"),
            l["n_dup_lines"].alias("n_dup_lines"), w["n_repeat_words"].alias("n_repeat_words"),
            l["n_lines"].alias("n_lines"), (l["n_lines"] - kept_lines).alias("n_failed_lines"),
            base.alias("base_failed"),
            (~base & (kept_chars >= rules.min_kept * l["chars"])).alias("kept"),
            F.when(source.isNotNull(), F.array_join(l["kept_lines"], "\n")).alias("cleaned"),
        )

    return both.withColumn("quality", _let(F.col("quality"), lambda q: verdict(q["w"], q["l"])))
