"""Line-first cleaning: rules judge every line, failing lines go, and so do documents that lose too much text.

Everything is one projection of Spark columns over the text; there is no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.llm.native import SPACE, WORD, let, pieces, whole

SYMBOLS = "#*$%&|<>"
WINDOW = 5
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
#: A document goes if its failing lines hold more than this percentage of the characters of all lines.
MAX_LOST_PERCENT = 50
#: Line rules. A sentence ends in one of these; a line of navigation has so many separators or is one of these
#: entries; boilerplate holds one of the stock phrases of sites and licences.
ENDS = ".!?:;…。！？\"'”’»)]"
SEPARATORS = "|»›•·"
MIN_SEPARATORS = 3
ENTRIES = ("home", "menu", "next", "previous", "login", "log in", "sign in", "sign up", "search", "share", "read more")
PHRASES = (
    "all rights reserved", "licensed under", "released under", "general public license", "terms of use", "terms of service",
    "privacy policy", "cookie", "enable javascript", "lorem ipsum", "click here", "subscribe to",
)
#: Characters around a line that the rules for ends and entries pass over.
BLANKS = " \t\r\x0b\f"
#: Percentages of a line's characters.
MAX_SYMBOL_PERCENT = 10
MAX_MARK_PERCENT = 8


def _count(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column, window: int = WINDOW) -> Column:
    """Number of words that lie in a window found at least twice in ``words``."""

    def covered(at: Column) -> Column:
        step = F.transform(at, lambda p, k: F.least(F.lit(window), F.coalesce(F.get(at, k + 1) - p, F.lit(window))))
        return F.aggregate(step, F.lit(0).cast("long"), lambda s, x: s + x)

    def again(order: Column) -> Column:
        same = lambda x, y: F.coalesce(x["h"] == y["h"], F.lit(False))
        found = F.filter(order, lambda x, k: same(x, F.get(order, k - 1)) | same(x, F.get(order, k + 1)))
        return let(F.array_sort(F.transform(found, lambda x: x["i"])), covered)

    def count(hashes: Column) -> Column:
        order = F.array_sort(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")).otherwise(let(order, again))

    def windows(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - window)
        hashes = F.transform(starts, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(window)]))
        return F.when(F.size(w) > window, let(hashes, count)).otherwise(F.lit(0).cast("long"))

    return let(F.transform(words, lambda w: F.xxhash64(w)), windows)  # each word is hashed once


def failing(line: Column) -> Column:
    """Whether a line fails a rule: no end of a sentence, navigation, boilerplate, or too many symbols or marks."""
    size = F.length(line)
    symbols = SYMBOLS + "=_~^\\{}[]"
    crowded = (
        (_count(line, SEPARATORS) >= MIN_SEPARATORS)
        | (100 * _count(line, symbols) > MAX_SYMBOL_PERCENT * size)
        | (100 * _count(line, "!?") > MAX_MARK_PERCENT * size)
    )

    def wording(folded: Column) -> Column:
        fails = ~F.substring(folded, -1, 1).isin(*ENDS) | folded.isin(*ENTRIES)
        for phrase in PHRASES:
            fails |= F.contains(folded, F.lit(phrase))
        return fails

    # Most lines have none of the counted characters, and are counted once.
    counted = "".join(dict.fromkeys(SEPARATORS + symbols + "!?"))
    return let(F.lower(F.trim(line, F.lit(BLANKS))), wording) | ((_count(line, counted) > 0) & crowded)


def judge_lines(docs: DataFrame, max_lost_percent: int = MAX_LOST_PERCENT) -> DataFrame:
    """Measures, verdict and cleaned text of every row of ``docs``.

    Columns: doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines,
    n_failing_lines, lost_chars, line_chars, cleaned. A null text counts as empty: no words, so
    ``base_failed``, and the cleaned text is empty. Lines without a word are neither counted nor cleaned.
    ``kept`` is false if ``base_failed``, or if failing lines hold more than ``max_lost_percent`` of the
    characters. Equal windows are found by 64-bit hashes within one text. Repeated rows and ids are judged
    alone; other columns are not read. No rows give no rows.
    """
    text = whole()
    words = pieces(text, SPACE)
    has_word = lambda line: line.rlike(WORD)

    def of_lines(lines: Column) -> Column:
        judged = F.transform(lines, lambda x: F.struct(x.alias("line"), failing(x).alias("bad")))

        def totals(rows: Column) -> Column:
            bad = F.filter(rows, lambda r: r["bad"])
            chars = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, r: s + F.length(r["line"]))
            return F.struct(
                F.size(rows).cast("long").alias("n_lines"),
                (F.size(rows) - F.size(F.array_distinct(F.transform(rows, lambda r: r["line"])))).cast("long").alias("n_dup_lines"),
                F.size(bad).cast("long").alias("n_failing_lines"),
                chars(bad).alias("lost_chars"),
                chars(rows).alias("line_chars"),
                F.array_join(F.transform(F.filter(rows, lambda r: ~r["bad"]), lambda r: r["line"]), "\n").alias("cleaned"),
            )

        return let(judged, totals)

    def of_words(w: Column) -> Column:
        return F.struct(F.size(w).cast("long").alias("n_words"), repeated_words(w).alias("n_repeat_words"))

    found = docs.select(
        "doc_id",
        let(words, of_words).alias("w"),
        let(F.filter(F.split(text, "\n", -1), has_word), of_lines).alias("l"),
        _count(text, SYMBOLS).cast("long").alias("n_symbols"),
        F.length(F.translate(text, " \t\n\x0b\f\r", "")).cast("long").alias("word_chars"),
    ).select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines", "l.n_failing_lines", "l.lost_chars", "l.line_chars", "l.cleaned")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= max_lost_percent * F.col("line_chars"))
    )
