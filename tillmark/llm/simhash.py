"""Near-duplicate documents by 64-bit SimHash, with pigeonring candidate filtering.

A fingerprint is cut into a ring of segments. If two fingerprints differ in at most ``tau`` bits, some
segment starts a chain in which every prefix of ``l`` segments differs in at most ``l * tau / segments``
bits. Chains of ``CHAIN`` segments within these budgets always have some of a few sets of segments
without any difference; these sets are the join keys. A joined pair must then hold a whole chain
within its budgets before its Hamming distance is looked at.

A key that more than ``HOT_KEY`` fingerprints share, a group of many near copies, gives no pairs. Its fingerprints are
linked by points instead: two of them at most four bits apart have a point at most two bits from both, and all at
most two bits from one point are at most four apart. Each is linked to the least fingerprint at each of its points,
so the work is in proportion to their number, and a point's group has no more members than such a ball has places.
"""

from __future__ import annotations

import itertools
import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from tillmark.llm.components import components
from tillmark.llm.texts import with_texts
from tillmark.session import checkpointed

SHINGLE = 4
SEED = 42
BITS = 64
TAU = 4
SEGMENTS = 8
CHAIN = 5
HASHES_AT_ONCE = 1 << 16
#: Fingerprints that share a key beyond which they are linked by points rather than by pairs.
HOT_KEY = 500


def fingerprint(text: str | None) -> int:
    """SimHash of a text's word shingles as an unsigned integer; 0 without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: only A-Z and ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - SHINGLE + 1)
    counts = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, HASHES_AT_ONCE):
        block = words[at : at + HASHES_AT_ONCE + SHINGLE - 1]
        line = b" ".join(block)
        ends = np.cumsum([len(w) + 1 for w in block]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        m = min(HASHES_AT_ONCE, n - at)
        spans = zip(starts[:m].tolist(), ends[min(SHINGLE, len(block)) - 1 :].tolist())
        hashes = np.array([xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype=">u8")
        counts += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp)`` of every row, the fingerprint as a signed long."""
    signed = lambda texts: np.array([fingerprint(t) for t in texts], dtype=np.uint64).view(np.int64)
    return with_texts(docs, ["doc_id"], "text", {"fp": "bigint"}, lambda texts: [signed(texts)])


def exact_sets(segments: int = SEGMENTS, tau: int = TAU, chain: int = CHAIN) -> list[tuple[int, ...]]:
    """Smallest sets of segments of a chain, one of which is free of differences if the chain is within its budgets."""
    budgets = [length * tau // segments for length in range(1, chain + 1)]
    free = set()
    for errors in itertools.product(range(budgets[-1] + 1), repeat=chain):
        if all(sum(errors[: k + 1]) <= budget for k, budget in enumerate(budgets)):
            free.add(frozenset(i for i, e in enumerate(errors) if e == 0))
    return sorted(tuple(sorted(s)) for s in free if not any(other < s for other in free))


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _mask(segment: int, segments: int) -> int:
    low, high = BITS * segment // segments, BITS * (segment + 1) // segments
    return ((1 << high) - 1) ^ ((1 << low) - 1)


def _literal(mask: int) -> str:
    return f"({_signed(mask)}L)" if _signed(mask) != -(1 << 63) else "(-9223372036854775807L - 1L)"


def _keys(segments: int, tau: int, chain: int) -> tuple[Column, list[tuple[int, ...]], list[int]]:
    """The keys of a fingerprint as an expression, with the sets of segments and the segments' masks behind them."""
    sets = exact_sets(segments, tau, chain)
    masks = [_mask(s, segments) for s in range(segments)]
    keys = []
    for start in range(segments):
        for k, free in enumerate(sets):
            mask = 0
            for s in free:
                mask |= masks[(start + s) % segments]
            keys.append(f"struct({start * len(sets) + k} as kid, fp & {_literal(mask)} as part)")
    return F.expr(f"explode(array({', '.join(keys)}))"), sets, masks


def keyed_prints(distinct_prints: DataFrame, segments: int = SEGMENTS, tau: int = TAU, chain: int = CHAIN) -> DataFrame:
    """``(fp, kid, part)``: every fingerprint under all its keys."""
    return distinct_prints.select("fp").withColumn("key", _keys(segments, tau, chain)[0]).select("fp", "key.kid", "key.part")


def links(keyed: DataFrame, segments: int = SEGMENTS, tau: int = TAU, chain: int = CHAIN) -> DataFrame:
    """All pairs ``(a, b, distance)``, a < b, of fingerprints that share a key and differ in 1 to ``tau`` bits.

    Each pair leaves the join once: under the first segment that starts a chain within its budgets, and
    the first of this chain's sets without a difference. Keys hold half of the bits that a chain covers,
    so pairs that share a key by chance stay few. Spark sizes the keys like the fingerprints that they are
    exploded from and would broadcast them, so the join is held to a merge.
    """
    _, sets, masks = _keys(segments, tau, chain)
    left, right = keyed.select(F.col("fp").alias("a"), "kid", "part").alias("l"), keyed.hint("merge").alias("r")
    differs = [f"bit_count((a ^ r.fp) & {_literal(m)})" for m in masks]
    starts, firsts = [], []
    for start in range(segments):
        ring = [differs[(start + s) % segments] for s in range(chain)]
        within = " and ".join(f"{' + '.join(ring[: k + 1])} <= {(k + 1) * tau // segments}" for k in range(chain))
        starts.append(f"when {within} then {start}")
        choice = " ".join(f"when {' + '.join(ring[s] for s in free)} = 0 then {k}" for k, free in enumerate(sets))
        firsts.append(f"when {start} then case {choice} end")
    first_start = f"case {' '.join(starts)} end"
    condition = (
        "l.kid = r.kid and l.part = r.part and a < r.fp "
        f"and l.kid div {len(sets)} = {first_start} "
        f"and l.kid % {len(sets)} = case l.kid div {len(sets)} {' '.join(firsts)} end "
        f"and bit_count(a ^ r.fp) <= {tau}"
    )
    return left.join(right, F.expr(condition)).select("a", F.col("r.fp").alias("b"), F.expr("bit_count(a ^ r.fp)").alias("distance"))


def point_links(prints: DataFrame, tau: int = TAU) -> DataFrame:
    """Links ``(a, b)`` that connect all of ``prints`` (``fp``, distinct) that differ in at most ``tau`` bits, an even number, by shared points."""
    near = [sum(1 << i for i in bits) for n in range(tau // 2 + 1) for bits in itertools.combinations(range(BITS), n)]
    offsets = F.lit(np.array([_signed(m) for m in near], dtype=np.int64))
    points = prints.select("fp", F.explode(offsets).alias("offset")).select("fp", F.col("fp").bitwiseXOR(F.col("offset")).alias("point"))
    met = points.groupBy("point").agg(F.collect_list("fp").alias("fps")).where(F.size("fps") > 1)
    return met.select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).where("a != b").distinct()


def all_links(prints: DataFrame, tau: int = TAU, hot_key: int = HOT_KEY) -> DataFrame:
    """Links ``(a, b)`` that connect the fingerprints as all pairs at most ``tau`` bits apart would."""
    keyed = keyed_prints(prints, tau=tau)
    hot = checkpointed(keyed.groupBy("kid", "part").agg(F.count("*").alias("n")).where(F.col("n") > hot_key).select("kid", "part"))
    if tau % 2 or hot.isEmpty():
        return links(keyed, tau=tau).select("a", "b")
    cold = keyed.join(hot, ["kid", "part"], "left_anti")
    crowded = checkpointed(keyed.join(hot, ["kid", "part"], "left_semi").select("fp").distinct())
    return links(cold, tau=tau).select("a", "b").unionByName(point_links(crowded, tau))


def near_duplicates(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` of every row of ``docs``.

    Documents with fingerprints at most ``tau`` bits apart are linked, and so is whatever they reach;
    ``component_id`` is the smallest ``doc_id`` of all. Fingerprints are linked, not documents, so any
    number of equal texts is one node. Null and empty texts, and texts of white space, have the
    fingerprint zero and link like any other. Rows that repeat a ``doc_id`` are rows of the result. A
    null ``doc_id`` never names a component unless no other is there (then null). Very long texts are hashed
    in blocks of shingles. Other columns, whatever their names, are not read. No rows give no rows.
    """
    rows = checkpointed(fingerprints(docs))
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = components(all_links(prints, tau))
    named = prints.join(roots, prints.fp == roots.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = checkpointed(named)
    classes = named.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = named.join(classes, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", F.expr("lower(lpad(hex(fp), 16, '0'))").alias("fingerprint"), "component_id")


def drop_near_duplicates(docs: DataFrame, tau: int = TAU) -> DataFrame:
    """``docs`` with one document of each group: that with the smallest ``doc_id``; rows that repeat its id stay with it.

    Rows without a ``doc_id`` stay only if their whole group has none.
    """
    found = near_duplicates(docs.select("doc_id", "text"), tau)
    kept = found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__kept"]), "left_semi")
