"""Spelling variants: words one edit apart, found by asymmetric chunks, and the common form of each.

Of two words one edit apart the longer one (of equally long ones either) gives disjoint chunks, its two halves; the
other gives its positional grams, the pieces as long as such chunks. The edit takes or replaces one code point of the
longer word, so it spares one half, which the other word holds in place or, behind a lost code point, shifted by one.
By the same argument it spares one of the two parts of the half that it meets. The join key is therefore the spared
half together with the spared part: words that merely share a common beginning or ending do not meet. Words that
share a key are then verified by their edit distance.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillmark.session import checkpointed

# Fixed values of the contract: what a run is, which runs lose a code point, and which words count.
RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOSES_ONE = 97
LEAST_LENGTH = 5
LEAST_COUNT = 3
#: A near word is a word's form if it is at least so many times as frequent.
RATIO = 2

#: Distinct words that a task holds before it hands their counts on.
WORDS_AT_ONCE = 300_000
_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def words_of(doc_id: object, text: str | None) -> Counter:
    """Words of a text with their counts: runs in lower case (only A-Z), some of them without one code point."""
    found: Counter = Counter()
    salt = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in Counter(RUN.findall((text or "").translate(_LOWER))).items():
        code = zlib.crc32(run.encode(), salt)
        if code % LOSES_ONE == 0:
            at = code % len(run)
            run = run[:at] + run[at + 1 :]
        found[run] += n
    return found


def word_counts(docs: DataFrame) -> DataFrame:
    """``(word, n)`` of every word of at least ``LEAST_LENGTH`` code points, ``n`` its count in all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], ["word", "n"])

        held: dict[str, int] = defaultdict(int)
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text")
            for k, doc_id in enumerate(ids):
                for word, n in words_of(doc_id, texts[k].as_py()).items():
                    if len(word) >= LEAST_LENGTH:
                        held[word] += n
                if len(held) >= WORDS_AT_ONCE:
                    yield out()
                    held.clear()
        yield out()

    counted = docs.select("doc_id", "text").mapInArrow(count, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def _key(length: Column, start: int, starts: list[Column], ends: list[Column]) -> Column:
    """Hash of what a word holds around part ``start`` of a word of ``length``: all before it, and all behind it up to the end."""
    before = F.col("word").substr(F.lit(1), starts[start])
    behind = F.when(ends[start] < length, F.expr("word").substr(F.char_length("word") - (length - ends[start]) + 1, length - ends[start])).otherwise("")
    return F.xxhash64(length, F.lit(start), before, behind)


def _keys(length: Column) -> Column:
    """The four keys of a word, each the half spared and the part spared, laid out as for a word of ``length``."""
    half = F.floor(length / 2)
    marks = [F.lit(0), F.floor(half / 2), half, half + F.floor((length - half) / 2), length]
    marks = [m.cast("int") for m in marks]
    return F.array(*[_key(length, k, marks[:-1], marks[1:]) for k in range(4)])


def near_words(words: DataFrame) -> DataFrame:
    """Links ``(word, n, other, other_n)``, both ways and once each, of words one edit apart in ``words`` ``(word, n)``."""
    length = F.char_length("word")
    chunks = words.select("word", "n", F.explode(_keys(length)).alias("key"))
    grams = words.select("word", "n", F.explode(_keys(length + 1)).alias("key"))
    other = chunks.unionByName(grams).select("key", F.col("word").alias("other"), F.col("n").alias("other_n"))
    # grams reach a longer word, whose length is in the key; among equally long words the lesser one gives the chunks
    ordered = (F.char_length("other") < length) | (F.col("word") < F.col("other"))
    pairs = chunks.join(other, "key").where(ordered & (F.levenshtein("word", "other", 1) == 1))
    both = F.array(F.struct("word", "n", "other", "other_n"), F.struct(F.col("other").alias("word"), F.col("other_n").alias("n"), F.col("word").alias("other"), F.col("n").alias("other_n")))
    # a lost code point of a run across two parts spares several keys; one exchange by word serves this and what groups by word
    return pairs.select(F.inline(both)).repartition("word").dropDuplicates(["word", "other"])


def with_roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` of every row of ``forms`` ``(word, form)``, the form reached last.

    A form is more frequent than its word, so forms make no circle; each round doubles how far a root
    reaches and is written to the checkpoint folder, and a chain of n forms takes log2(n) rounds.
    """
    roots = checkpointed(forms.select("word", F.col("form").alias("root")))
    while True:
        ahead = roots.select(F.col("word").alias("at"), F.col("root").alias("further"))
        step = checkpointed(roots.join(ahead, roots.root == ahead["at"], "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = step.select("word", "root")
        if step.where("moved").isEmpty():
            return roots


def spelling_variants(docs: DataFrame, least_count: int = LEAST_COUNT, ratio: int = RATIO) -> DataFrame:
    """``(word, n, n_near, form, form_n, root)`` of every word of at least ``least_count`` occurrences in ``docs``.

    ``form`` is the near word of largest ``n`` (ties: smallest in code-point order) if that is at least
    ``ratio`` times the word's own, else null; ``root`` the word reached by following forms, or the word itself.

    Null and empty texts have no words; a null ``doc_id`` counts as an empty one. Repeated rows count each. Very
    long texts are read whole, and a task's counts are handed on by ``WORDS_AT_ONCE``. Only ``doc_id`` and ``text``
    are read, so other columns may have any names. No rows, or no words, give no rows.
    """
    words = checkpointed(word_counts(docs).where(F.col("n") >= least_count))
    best = F.min(F.struct((-F.col("other_n")).alias("less"), "other"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"), F.first("n").alias("own"))
    fits = -F.col("best.less") >= ratio * F.col("own")
    near = checkpointed(near.select("word", "n_near", F.when(fits, F.col("best.other")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")))
    roots = with_roots(near.where("form is not null"))
    found = words.join(near, "word", "left").join(roots, "word", "left")
    return found.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n")
