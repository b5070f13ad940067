"""Secret scans: fixed patterns, and credential formats inferred as probabilistic automata.

Values that the fixed patterns find label the formats. Per kind the prefix tree of all of them, counted by Spark, is
merged into a probabilistic automaton, whose steps are then counted over all of them. Every other long run of
credential characters in the corpus is scored by its likelihood under these automata against a chain of all such runs;
a run as likely as the labelled values are is a secret too.
"""

from __future__ import annotations

import functools
import math
import re
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillmark.llm.automata import Automaton, Background, chain_steps, infer_from_prefixes, symbols
from tillmark.llm.texts import with_texts
from tillmark.operators.quantiles import quantiles
from tillmark.session import checkpointed

# The base patterns and the least lengths of what they must match.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LENGTH, ACCESS_LENGTH, HEX_LENGTH = 6, 20, 24
KINDS = ("assign", "access", "hex")
LEARNED = "format"

RUN_LENGTH = 16
_RUN = re.compile(r"[A-Za-z0-9+/_.=-]{16,}")
_LONG_HEX = re.compile(r"[0-9a-f]{24}")
_KEYWORDS = ("passw", "secret", "token", "api")

#: A prefix is a state of its kind's tree if two values and this share of all pass it, and it is no longer than this.
#: That bounds the states on the driver, not the values: those that leave the tree are counted on from its start.
TREE_SHARE = 1 / 400
TREE_DEPTH = 64
#: A run is a secret if it gains as many bits a character as all but this share of the labelled values, and this many.
LOWEST_SHARE = 0.05
LEAST_GAIN = 0.75
MASK = "[secret]"


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """``(kind, start, end, value)`` of the fixed patterns, by start and then kind; the value is the credential itself."""
    found = []
    folded = text.lower()
    if any(word in folded for word in _KEYWORDS):
        found += [("assign", *m.span(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LENGTH]
    if "AKIA" in text:
        found += [("access", *m.span(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_LENGTH]
    if any(len(word) >= HEX_LENGTH for word in text.split()) and _LONG_HEX.search(text):
        found += [("hex", *m.span(), m.group()) for m in HEX.finditer(text) if len(m.group()) >= HEX_LENGTH]
    return sorted(found, key=lambda x: (x[1], KINDS.index(x[0])))


def other_runs(text: str, base: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """Long runs of credential characters that no base span overlaps."""
    if not any(len(word) >= RUN_LENGTH for word in text.split()):
        return []
    taken = [(a, b) for _, a, b, _ in base]
    return [(*m.span(), m.group()) for m in _RUN.finditer(text) if all(m.end() <= a or b <= m.start() for a, b in taken)]


@dataclass
class Formats:
    """Automata of the labelled kinds, the least gain of each, and the chain of ordinary runs."""

    automata: dict[str, tuple[Automaton, float]]
    ordinary: Background

    def gain(self, automaton: Automaton, value: str) -> float:
        """Bits a character that the automaton saves against the ordinary chain."""
        return (automaton.log_likelihood(value) - self.ordinary.log_likelihood(value)) / len(value)

    def is_secret(self, value: str) -> bool:
        return any(self.gain(a, value) >= least for a, least in self.automata.values())

    def spans(self, text: str | None) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int]]]:
        """Base spans, and all spans, by start."""
        text = text or ""
        found = base_spans(text)
        base = [x[:3] for x in found]
        learned = [(LEARNED, a, b) for a, b, value in other_runs(text, found) if self.is_secret(value)]
        return base, sorted(base + learned, key=lambda x: (x[1], (*KINDS, LEARNED).index(x[0])))


def _value_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind and value of all labelled values and other runs."""
    for batch in batches:
        rows = []
        for text in batch.column("text").to_pylist():
            text = text or ""
            base = base_spans(text)
            rows += [(kind, value) for kind, _, _, value in base] + [(LEARNED, value) for _, _, value in other_runs(text, base)]
        yield _columns(rows, {"kind": pa.string(), "value": pa.string()})


def _columns(rows: list[tuple], types: dict[str, pa.DataType]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=t) for k, t in enumerate(types.values())], list(types))


def _paths(batch: pa.RecordBatch) -> Counter[tuple[str, str]]:
    """Values of a batch by kind and symbols, in digits: all that the automata see of them."""
    kinds, values = (batch.column(name).to_pylist() for name in ("kind", "value"))
    return Counter((kind, "".join(map(str, symbols(value)))) for kind, value in zip(kinds, values))


def _prefix_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Prefixes of labelled values and the numbers of values that pass and end there."""
    for batch in batches:
        passed, ended = Counter(), Counter()
        for (kind, path), n in _paths(batch).items():
            passed.update({(kind, path[:k]): n for k in range(min(len(path), TREE_DEPTH) + 1)})
            if len(path) <= TREE_DEPTH:
                ended[kind, path] += n
        rows = [(*node, n, ended[node]) for node, n in passed.items()]
        yield _columns(rows, {"kind": pa.string(), "prefix": pa.string(), "passed": pa.int64(), "ended": pa.int64()})


def _step_rows(automata: dict[str, Automaton]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Table function: steps of the values through the automaton of their kind, or of the chain for other runs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            steps: dict[str, Counter[tuple[int, int]]] = defaultdict(Counter)
            for (kind, path), n in _paths(batch).items():
                path = [int(s) for s in path]
                if kind in automata:
                    automata[kind].walk(path, n, steps[kind])
                else:
                    steps[kind].update({step: times * n for step, times in chain_steps(path).items()})
            rows = [(kind, *step, n) for kind, taken in steps.items() for step, n in taken.items()]
            yield _columns(rows, {"kind": pa.string(), "state": pa.int64(), "symbol": pa.int64(), "n": pa.int64()})

    return run


def _trees(labelled: DataFrame) -> dict[str, Automaton]:
    """The merged prefix tree of all values of each kind; a bounded number of prefixes reaches the driver."""
    nodes = labelled.mapInArrow(_prefix_rows, "kind string, prefix string, passed bigint, ended bigint")
    nodes = checkpointed(nodes.groupBy("kind", "prefix").agg(F.sum("passed").alias("passed"), F.sum("ended").alias("ended")))
    least = {r["kind"]: max(2, math.ceil(r["passed"] * TREE_SHARE)) for r in nodes.where("prefix = ''").collect()}
    if not least:
        return {}
    bound = functools.reduce(lambda found, kind: F.when(F.col("kind") == kind, least[kind]).otherwise(found), least, F.lit(0))
    # states, and the steps that leave one
    states = nodes.where((F.col("passed") >= bound) | (F.col("prefix") == "")).select("kind", F.col("prefix").alias("parent"))
    parent = F.expr("if(prefix = '', '', left(prefix, length(prefix) - 1))")
    found: dict[str, list[tuple[str, int, int]]] = defaultdict(list)
    for r in nodes.withColumn("parent", parent).join(states, ["kind", "parent"], "left_semi").collect():
        found[r["kind"]].append((r["prefix"], r["passed"], r["ended"]))
    return {kind: infer_from_prefixes(found[kind], least[kind]) for kind in KINDS if kind in found}


def fit(docs: DataFrame) -> Formats:
    """Formats of the credentials that the fixed patterns find in all of ``docs``; distinct values count once.

    All values and runs are counted: prefixes, then steps through the merged trees and along the chain, then gains,
    whose quantile is exact. The driver gets the states and these counts.
    """
    values = checkpointed(docs.select("text").mapInArrow(_value_rows, "kind string, value string").distinct())
    labelled = values.where(F.col("kind") != LEARNED)
    trees = _trees(labelled)
    steps: dict[str, list[tuple[int, int, int]]] = defaultdict(list)
    counted = values.mapInArrow(_step_rows(trees), "kind string, state bigint, symbol bigint, n bigint")
    for r in counted.groupBy("kind", "state", "symbol").agg(F.sum("n").alias("n")).collect():  # a row a state and symbol
        steps[r["kind"]].append((r["state"], r["symbol"], r["n"]))
    automata = {kind: tree.counted(steps[kind]) for kind, tree in trees.items()}
    formats = Formats({}, Background({(a, b): n for a, b, n in steps[LEARNED]}))
    if not automata:
        return formats

    def gain_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pairs = zip(batch.column("kind").to_pylist(), batch.column("value").to_pylist())
            rows = [[formats.gain(automata[kind], value) if kind == k else None for k in automata] for kind, value in pairs]
            yield _columns(rows, {kind: pa.float64() for kind in automata})

    gains = checkpointed(labelled.mapInArrow(gain_rows, ", ".join(f"{kind} double" for kind in automata)))
    lowest = {r["variable"]: r["low"] for r in quantiles(gains, list(automata), {"low": LOWEST_SHARE}).collect()}
    formats.automata = {kind: (automaton, max(LEAST_GAIN, lowest[kind])) for kind, automaton in automata.items()}
    return formats


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, base, spans)`` of every row of ``docs``: arrays of ``(kind, start, end)``, by start and then kind.

    Places are code points, ends exclusive. ``base`` holds what the fixed patterns find, ``spans`` also the
    runs of an inferred format, of kind ``format``, which never overlap base spans. Null and empty texts
    have none. Without any labelled credential there are no formats. Repeated rows are scanned alone, and
    their values count once for the formats. Other columns are not read. No rows give no rows.
    """
    formats = fit(docs)

    def scan(texts: list) -> list[list]:
        found = [formats.spans(text) for text in texts]
        return [[[{"kind": k, "start": a, "end": b} for k, a, b in row[side]] for row in found] for side in (0, 1)]

    spans = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    return with_texts(docs, ["doc_id"], "text", {"base": spans, "spans": spans}, scan)


def redact(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret replaced by ``MASK`` and ``n_chars``, if there, set to the new length of such texts.

    Overlapping spans become one mask. Rows without a secret, null texts included, stay as they are.
    """
    formats = fit(docs)

    @F.pandas_udf("string")
    def masked(texts: pd.Series) -> pd.Series:
        return pd.Series([None if t is None else mask(t, formats.spans(t)[1]) for t in texts], dtype=object)

    seen = docs.withColumn("__masked", masked("text"))
    if "n_chars" in docs.columns:
        same = F.col("__masked").eqNullSafe(F.col("text"))
        length = F.length("__masked").cast(docs.schema["n_chars"].dataType)
        seen = seen.withColumn("n_chars", F.when(same, F.col("n_chars")).otherwise(length))
    return seen.withColumn("text", F.col("__masked")).drop("__masked")


def mask(text: str, spans: list[tuple[str, int, int]]) -> str:
    parts, at = [], 0
    for _, start, end in spans:
        if start >= at:
            parts += [text[at:start], MASK]
        at = max(at, end)
    return "".join([*parts, text[at:]])
