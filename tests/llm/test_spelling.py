"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st

from tillmark.llm import spelling


def brute_words(docs):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            code = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if code % 97 == 0:
                run = run[: code % len(run)] + run[code % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if abs(len(a) - len(b)) != 1:
        return False
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(docs):
    words = brute_words(docs)
    close = {w: [v for v in words if near(w, v)] for w in words}
    forms = {}
    for w, others in close.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        forms[w] = best if best and words[best] >= 2 * words[w] else None
    found = []
    for w, n in words.items():
        root = w
        while forms[root]:
            root = forms[root]
        found.append((w, forms[w], root, n, len(close[w]), words[forms[w]] if forms[w] else None))
    return sorted(found, key=str)


def texts(rng, n=400):
    stems = ["international", "abcde", "aabbaabb", "caféteria", "straße", "ÀÉÎõü", "colour", "aaaaaa", "zzzzzzzzzzzzzzzzzz"]
    docs = []
    for k in range(n):
        words = []
        for _ in range(rng.randint(0, 60)):
            w = rng.choice(stems)
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2, 3])):
                at = rng.randrange(len(w))
                w = rng.choice([w[:at] + w[at + 1 :], w[:at] + rng.choice("aéz") + w[at:], w[:at] + rng.choice("abz") + w[at + 1 :]]) or "a"
            words.append(w.title() if rng.random() < 0.2 else w)
        docs.append((k, rng.choice([" ", ", ", "\n", "×"]).join(words)))
    return docs


def got(spark, docs, **extra):
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    return sorted(map(tuple, spelling.spelling_variants(df.repartition(3)).collect()), key=str)


def test_variants_match_brute_force(spark):
    docs = texts(random.Random(4))
    want = brute(docs)
    assert len(want) > 150 and sum(r[1] is not None for r in want) > 30 and any(r[2] != r[1] and r[1] for r in want)
    assert got(spark, docs) == want


def test_nulls_empties_repeats_and_long_texts(spark):
    docs = [(1, None), (None, "hello hello hellp"), (2, ""), (3, "hellp hello hellp"), (3, "hellp hello hellp"), (4, "a b c"), (5, "w" * 100_000 + " "), (5, "w" * 100_000), (5, "w" * 100_000)]
    assert got(spark, docs) == brute(docs)
    assert got(spark, [(6, "hello " * 200_000 + "hellp " * 4)]) == brute([(6, "hello " * 200_000 + "hellp " * 4)])


def test_no_words_and_clashing_columns(spark):
    assert got(spark, []) == [] and got(spark, [(1, "one two")]) == []
    df = spark.createDataFrame([(1, "hello hello hello", 5, "x", "y")], "doc_id bigint, text string, n int, word string, key string")
    assert [tuple(r) for r in spelling.spelling_variants(df).collect()] == [("hello", None, "hello", 3, 0, None)]


def test_counts_are_handed_on_in_parts(spark, monkeypatch):
    docs = texts(random.Random(8), 30)
    monkeypatch.setattr(spelling, "WORDS_AT_ONCE", 7)
    df = spark.createDataFrame(docs, "doc_id bigint, text string").coalesce(1)
    found = {r["word"]: r["n"] for r in spelling.word_counts(df).collect()}
    assert {w: n for w, n in found.items() if n >= 3} == brute_words(docs)


def test_chains_of_forms_are_followed_to_the_end(spark):
    chain = [(f"w{k}", f"w{k + 1}") for k in range(37)]
    roots = {r["word"]: r["root"] for r in spelling.with_roots(spark.createDataFrame(chain, "word string, form string")).collect()}
    assert roots == {f"w{k}": "w37" for k in range(37)}


@settings(max_examples=15, deadline=None)
@given(st.sets(st.text("ab", min_size=5, max_size=9), max_size=25))
def test_links_of_repetitive_words(spark, words):
    df = spark.createDataFrame([(w, k) for k, w in enumerate(sorted(words))], "word string, n bigint")
    links = [(r["word"], r["other"]) for r in spelling.near_words(df).collect()]
    assert sorted(links) == sorted((a, b) for a in words for b in words if near(a, b))
