"""SimHash groups against brute force."""

import random

import numpy as np
import pytest
from xxhash import xxh64_intdigest

from tillmark.llm import simhash


def brute_fingerprint(text):
    words = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode()).split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if (prints[i] ^ prints[j]).bit_count() <= 4 and label[j] < label[i]:
                    label[i], changed = label[j], True
    ids = {}
    for (doc, _), l in zip(rows, label):
        if doc is not None:
            ids[l] = min(ids.get(l, doc), doc)
    return sorted([(doc, f"{p:016x}", ids.get(l)) for (doc, _), p, l in zip(rows, prints, label)], key=str)


def test_every_pair_within_tau_meets_a_set():
    rng = random.Random(1)
    sets = simhash.exact_sets()
    masks = [simhash._mask(s, 8) for s in range(8)]
    for _ in range(3000):
        x = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 4)))
        counts = [(x & m).bit_count() for m in masks]
        assert any(
            all(sum(counts[(s + i) % 8] for i in range(l)) <= l * 4 // 8 for l in range(1, 6))
            and any(all(counts[(s + i) % 8] == 0 for i in free) for free in sets)
            for s in range(8)
        )


def test_links_are_all_pairs_once(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(20)]
    prints = set(base)
    for b in base:
        for _ in range(25):
            prints.add(b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 5))))
    prints = sorted(np.array(list(prints), dtype=np.uint64).view(np.int64).tolist())
    found = simhash.links(simhash.keyed_prints(spark.createDataFrame([(p,) for p in prints], "fp bigint"))).collect()
    want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4}
    assert sorted((r.a, r.b) for r in found) == sorted(want)


def test_keys_are_not_broadcast(spark):
    prints = spark.createDataFrame([(i * 0x9E3779B97F4A7,) for i in range(300)] + [(i,) for i in range(3)], "fp bigint").groupBy("fp").count()
    for found in (simhash.links(simhash.keyed_prints(prints)), simhash.all_links(prints)):
        pairs = {(r.a, r.b) for r in found.collect()}
        plan = found._jdf.queryExecution().executedPlan().toString()  # the last, after Spark has seen real sizes
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
        assert pairs >= {(0, 1), (0, 2), (1, 2)}


def test_groups_match_brute_force(spark):
    rng = random.Random(3)
    words = ["The", "of", "rain", "Ärger", "x1", "stone", "river", "plain", "was", "there"]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE two"), (None, "only here and nowhere else at all")]
    for i in range(5, 60):
        rows.append((i, " ".join(rng.choices(words, k=rng.randint(1, 200)))))
    for i in range(60, 110):
        text = rows[rng.randrange(5, 60)][1].split()
        text[rng.randrange(len(text))] = "changed"
        rows.append((i, " ".join(text)))
    rows += [(7, rows[7][1]), (None, rows[8][1]), (200, "word " * 70000)]
    docs = spark.createDataFrame([(d, t, "clash", "clash") for d, t in rows], "doc_id bigint, text string, component_id string, fp string")
    got = sorted([tuple(r) for r in simhash.near_duplicates(docs).collect()], key=str)
    assert got == brute_groups(rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    want = {c for _, _, c in brute_groups(rows)}
    assert {r.doc_id for r in kept.collect()} == want


@pytest.mark.parametrize("size", [1, 7])
def test_chains_and_stars(spark, size):
    from tillmark.llm.components import components

    pairs = [(i, i + 1) for i in range(size * 5)] + [(100, 100 + i) for i in range(1, size)] + [(5, 5), (None, 3)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(pairs, "a bigint, b bigint")).collect())
    want = {i: 0 for i in range(size * 5 + 1)} | ({100 + i: 100 for i in range(size)} if size > 1 else {})
    assert got == want


def test_empty(spark):
    empty = spark.createDataFrame([], "doc_id bigint, text string")
    assert simhash.near_duplicates(empty).collect() == []


def components_of(pairs, nodes):
    label = {n: n for n in nodes}

    def root(n):
        while label[n] != n:
            label[n] = n = label[label[n]]
        return n

    for a, b in pairs:
        a, b = sorted((root(a), root(b)))
        label[b] = a
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("hot_key", [1, 8, 40])
def test_crowded_keys_connect_as_pairs_do(spark, hot_key):
    rng = random.Random(hot_key)
    prints = {rng.getrandbits(64) for _ in range(40)}
    for base in rng.sample(sorted(prints), 4):
        prints |= {base ^ sum(1 << i for i in rng.sample(range(64), rng.randint(1, 6))) for _ in range(120)}
    prints = sorted(np.array(sorted(prints), dtype=np.uint64).view(np.int64).tolist())
    found = [tuple(r) for r in simhash.all_links(spark.createDataFrame([(p,) for p in prints], "fp bigint"), hot_key=hot_key).collect()]
    close = [(a, b) for i, a in enumerate(prints) for b in prints[:i] if ((a ^ b) & (2**64 - 1)).bit_count() <= 4]
    assert all(((a ^ b) & (2**64 - 1)).bit_count() <= 4 for a, b in found)
    assert components_of(found, prints) == components_of(close, prints)


def test_blocks_of_a_long_text_hash_as_one(monkeypatch):
    texts = ["a b c", "one two three four", " ".join(f"w{k % 11}" for k in range(40)), "x " * 9]
    whole = [simhash.fingerprint(t) for t in texts]
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 3)
    assert [simhash.fingerprint(t) for t in texts] == whole == [brute_fingerprint(t) for t in texts]
