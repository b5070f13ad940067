"""Benchmark decontamination with a distributed positional inverted index.

The index holds, for the rarest terms of every benchmark window, their positions in all training texts. A
window is found where the position lists of its two rarest terms meet after their offsets are taken off;
the words around the position then confirm the exact phrase. A rarest term with the second one near it,
but without the phrase, is a proximity match. Training texts are read twice, once to count terms and once
to store positions, and are never shuffled; every shuffle carries positions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tillmark.llm.native import BROADCAST_ROWS, ascii_lower, pieces, whole
from tillmark.session import checkpointed

#: What separates words once A-Z is in lower case: all ASCII but digits and letters.
SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 13
#: A text is contaminated if at least one word of so many is hit.
HIT_FRACTION = 20
END = ""  # stands after the last word of every text; no word is empty


def text_words():
    return pieces(ascii_lower(whole()), SEPARATOR)


def windows(items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """Distinct windows ``(wid, phrase)``, and the items of each, ``(wid, item_id)``."""
    words = items.select("item_id", text_words().alias("words")).where("size(words) > 0")
    starts = F.explode(F.sequence(F.lit(1), F.greatest(F.lit(1), F.size("words") - (window - 1))))
    pieces = words.select("item_id", "words", starts.alias("at")).select("item_id", F.slice("words", F.col("at"), F.lit(window)).alias("phrase"))
    pieces = checkpointed(pieces.distinct().withColumn("wid", F.sha1(F.array_join("phrase", " "))))
    return pieces.select("wid", "phrase").distinct(), pieces.select("wid", "item_id").distinct()


def _blocks(terms: DataFrame, rows: int = BROADCAST_ROWS) -> list[DataFrame]:
    """Terms in blocks that may be broadcast, split by hash."""
    n = max(1, -(-terms.count() * 2 // rows))
    if n == 1:
        return [F.broadcast(terms)]
    return [F.broadcast(terms.where(F.pmod(F.xxhash64("term"), F.lit(n)) == k)) for k in range(n)]


def _tokens(docs: DataFrame) -> DataFrame:
    """A row for every word of every text and one for its end, with the text's words at hand."""
    words = docs.select("doc_id", F.xxhash64(whole()).alias("digest"), text_words().alias("words"))
    return words.select("doc_id", "digest", "words", F.posexplode(F.concat("words", F.array(F.lit(END)))).alias("pos", "term"))


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """``(term, n)``: occurrences in all texts of those ``terms`` that occur at all."""
    found = [_tokens(docs).select("term").join(block, "term", "left_semi").groupBy("term").agg(F.count("*").alias("n")) for block in _blocks(terms)]
    return _union(found)


def _union(frames: list[DataFrame]) -> DataFrame:
    whole_frame = frames[0]
    for frame in frames[1:]:
        whole_frame = whole_frame.unionByName(frame)
    return whole_frame


def anchors(phrases: DataFrame, counts: DataFrame) -> DataFrame:
    """``(wid, n_words, first, at_first, second, at_second)`` of the windows whose terms all occur: the two rarest.

    Of a term's places the first is its offset. A window of one distinct term has no second.
    """
    places = phrases.select("wid", F.size("phrase").alias("n_words"), F.posexplode("phrase").alias("at", "term"))
    places = places.groupBy("wid", "n_words", "term").agg(F.min("at").alias("at"))
    ranked = places.join(counts, "term", "left").groupBy("wid", "n_words").agg(
        F.min(F.coalesce("n", F.lit(0))).alias("least"), F.array_sort(F.collect_list(F.struct("n", "term", "at"))).alias("terms")
    )
    rank = lambda k, field: F.get("terms", F.lit(k))[field]
    return ranked.where("least > 0").select(
        "wid", "n_words", rank(0, "term").alias("first"), rank(0, "at").alias("at_first"), rank(1, "term").alias("second"), rank(1, "at").alias("at_second")
    )


def postings(docs: DataFrame, terms: DataFrame, window: int = WINDOW) -> DataFrame:
    """Positional index of ``terms``: ``(term, doc_id, digest, pos, around)``, the words around included.

    Every text has a row for its end too, whose position is its number of words. The words around are
    taken where the term was found, so the texts themselves are not shuffled.
    """
    found = []
    for k, block in enumerate(_blocks(terms)):
        block = block if k else block.unionByName(block.sparkSession.sql(f"select '{END}' as term"))
        hit = _tokens(docs).join(F.broadcast(block), "term", "left_semi")
        low = F.greatest(F.lit(0), F.col("pos") - (window - 1))
        around = F.when(F.col("term") != END, F.slice("words", low + 1, F.lit(2 * window - 1) - (low - (F.col("pos") - (window - 1)))))
        found.append(hit.select("term", "doc_id", "digest", "pos", F.least(F.col("pos"), F.lit(window - 1)).alias("centre"), around.alias("around")))
    return _union(found)


def matches(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Texts ``(doc_id, digest, n_words)``, phrase matches ``(doc_id, digest, start, n, wid)``, and the items of windows.

    Proximity matches are the rows with a null ``start``.
    """
    phrases, owners = windows(items, window)
    terms = checkpointed(phrases.select(F.explode("phrase").alias("term")).distinct())
    counts = checkpointed(term_counts(docs, terms))
    rarest = checkpointed(anchors(phrases, counts))
    wanted = checkpointed(rarest.select(F.explode(F.array_compact(F.array("first", "second"))).alias("term")).distinct())
    index = checkpointed(postings(docs, wanted, window))
    texts = index.where(F.col("term") == END).select("doc_id", "digest", F.col("pos").cast("long").alias("n_words"))

    lists = index.where(F.col("term") != END)
    by_term = rarest.join(phrases, "wid")
    first = lists.join(by_term.withColumnRenamed("first", "term"), "term").withColumn("start", F.col("pos") - F.col("at_first"))
    second = lists.select("term", "doc_id", "digest", "pos").join(rarest.select(F.col("second").alias("term"), "wid", "at_second"), "term")
    second = second.select("doc_id", "digest", "wid", (F.col("pos") - F.col("at_second")).alias("start"), F.lit(2).alias("list"))
    near = F.col("second").isNotNull() & F.array_contains("around", F.col("second"))
    seen = F.slice("around", F.greatest(F.lit(0), F.col("centre") - F.col("at_first")) + 1, F.col("n_words"))
    phrase_here = (F.col("start") >= 0) & (F.col("centre") >= F.col("at_first")) & (seen == F.col("phrase"))
    first = first.select("doc_id", "digest", "wid", "start", "n_words", F.lit(1).alias("list"), phrase_here.alias("exact"), near.alias("near"), "second")
    both = first.where("exact or near").unionByName(second.where("start >= 0"), allowMissingColumns=True)
    met = both.groupBy("doc_id", "digest", "wid", "start").agg(
        F.bit_or("list").alias("lists"), F.max("exact").alias("exact"), F.max("near").alias("near"), F.max("n_words").alias("n"), F.max("second").alias("second")
    )
    met = met.where("near or exact")
    phrase = F.col("exact") & ((F.col("lists") == 3) | F.col("second").isNull())
    return texts, met.select("doc_id", "digest", "wid", F.when(phrase, F.col("start")).alias("start"), "n"), owners


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, fraction: int = HIT_FRACTION) -> DataFrame:
    """``(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, n_near_items)`` of every row of ``docs``.

    A word is hit if it lies in an occurrence of a window of ``window`` words of an item (``item_id``,
    ``text``); an item of fewer words, but not none, is one window. ``n_items`` counts the distinct ids of
    items with occurring windows, ``n_near_items`` those with a proximity match only. Contaminated: hits
    at least one of ``fraction`` words. Null texts have no words, null items no windows; an item without id
    hits words but is not listed. Rows that repeat both id and text are rows of the result with equal values.
    Other columns are not read. No documents give no rows, no items give rows without hits.
    """
    texts, found, owners = matches(docs, items, window)
    found = checkpointed(found)
    starts = found.where("start is not null").groupBy("doc_id", "digest", "start").agg(F.max("n").alias("n"))
    by_text = Window.partitionBy("doc_id", "digest").orderBy("start")
    end_before = F.max(F.col("start") + F.col("n")).over(by_text.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.col("start") + F.col("n") - F.greatest("start", F.coalesce(end_before, F.lit(0)))
    hits = starts.select("doc_id", "digest", F.greatest(F.lit(0), fresh).alias("fresh")).groupBy("doc_id", "digest").agg(F.sum("fresh").alias("n_hit"))
    listed = found.groupBy("doc_id", "digest", "wid").agg(F.max(F.col("start").isNotNull()).alias("phrase")).join(owners, "wid")
    listed = listed.groupBy("doc_id", "digest", "item_id").agg(F.max("phrase").alias("phrase"))
    ids = F.array_sort(F.collect_list(F.when(F.col("phrase"), F.col("item_id").cast("string"))))
    named = listed.groupBy("doc_id", "digest").agg(ids.alias("ids"), F.count(F.when(~F.col("phrase"), F.col("item_id"))).alias("n_near_items"))
    key = ["doc_id", "digest"]
    same = lambda name: F.expr(f"l.doc_id <=> {name}.doc_id and l.digest = {name}.digest")
    rows = texts.alias("l").join(hits.alias("h"), same("h"), "left").join(named.alias("i"), same("i"), "left")
    n_hit = F.coalesce("h.n_hit", F.lit(0).cast("long"))
    listed_ids = F.coalesce("i.ids", F.array().cast("array<string>"))
    result = rows.select(
        *[F.col(f"l.{k}") for k in key],
        "l.n_words",
        n_hit.alias("n_hit"),
        F.size(listed_ids).cast("long").alias("n_items"),
        F.sha2(F.array_join(listed_ids, ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (fraction * n_hit >= F.col("l.n_words"))).alias("contaminated"),
        F.coalesce("i.n_near_items", F.lit(0).cast("long")).alias("n_near_items"),
    )
    return result


def drop_contaminated(docs: DataFrame, items: DataFrame, window: int = WINDOW, fraction: int = HIT_FRACTION) -> DataFrame:
    """``docs`` without the contaminated ones; rows that repeat a contaminated ``doc_id`` go with it, those without id alike."""
    bad = contamination(docs.select("doc_id", "text"), items, window, fraction).where("contaminated")
    bad = bad.select(F.col("doc_id").alias("__bad")).distinct()
    return docs.join(bad, docs["doc_id"].eqNullSafe(bad["__bad"]), "left_anti")
