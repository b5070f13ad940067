"""The pipeline stage by stage against brute force, and the whole run."""

import random
import re

import duckdb
import pytest
from test_learned import brute_base
from test_simhash import brute_groups

import corpus_pipeline
from tillmark.llm import catalog, quality, simhash

TABLES = "/root/testdata/sf0.001"
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOC_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """The small tables with copies, near copies, benchmark passages, secrets, nulls and repeated rows planted."""
    base = str(tmp_path_factory.mktemp("corpus"))
    docs = [tuple(r) for r in spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    bench = [r.text for r in spark.read.parquet(f"{TABLES}/benchmark.parquet").collect()]
    rng = random.Random(8)
    top = max(d[0] for d in docs) + 1
    planted = []
    for i in range(12):
        text = docs[rng.randrange(len(docs))][1]
        words = text.split(" ")
        words[rng.randrange(len(words))] = "changed"
        planted += [text, " ".join(words), f"{docs[i][1][:300]} {bench[i % len(bench)]}", f"{text[:200]} password=abc123DEF{i} done."]
    docs += [(top + i, t, "en", f"src{i % 3}" if i % 5 else None, len(t)) for i, t in enumerate(planted)]
    docs += [docs[0], (None, docs[5][1] + " and a tail.", None, None, None), (top + 900, None, "en", "src0", 0), (top + 901, "", "en", "src1", 0)]
    kinds = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    spark.createDataFrame([(*d, "x", "y") for d in docs], f"{kinds}, taken string, digest string").repartition(4).write.parquet(f"{base}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{TABLES}/{name}.parquet").write.parquet(f"{base}/{name}.parquet")
    return base


@pytest.fixture(scope="module")
def steps(spark, folder, tmp_path_factory):
    """Output of every stage, each written and read again."""
    docs, found = spark.read.parquet(f"{folder}/documents.parquet"), []
    found.append(docs)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path_factory.mktemp('stage')}/{k}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
        found.append(docs)
    return found


def texts(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


def test_columns_stay(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_classifier", "simhash_near_dedup", "benchmark_decontamination", "secret_scans", "source_mixing"]
    assert all(step.columns == steps[0].columns for step in steps[:-1])
    assert {"doc_id", "text", "size", "source_size", "target", "taken"} <= set(steps[-1].columns)


def test_quality_stage(spark, folder, steps):
    scores = quality.quality_scores(steps[0].select("doc_id", "text"), spark.read.parquet(f"{folder}/labels.parquet"))
    good = {r.doc_id for r in scores.where("score >= 0.7").collect()}
    assert texts(steps[1]) == [x for x in texts(steps[0]) if x[0] in good]


def test_near_copies_stage(steps):
    rows = texts(steps[1])
    keep = {doc for doc, _, component in brute_groups(rows) if doc == component}
    assert texts(steps[2]) == [x for x in rows if x[0] in keep]


def test_contamination_stage(spark, folder, steps):
    items = [DOC_WORD.findall((r.text or "").translate(LOWER)) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    windows = {tuple(w[i : i + 13]) for w in items if w for i in range(max(1, len(w) - 12))}
    lengths = {len(w) for w in windows}
    bad = set()
    for doc, text in texts(steps[2]):
        words = DOC_WORD.findall((text or "").translate(LOWER))
        hit = {i + k for n in lengths for i in range(len(words) - n + 1) if tuple(words[i : i + n]) in windows for k in range(n)}
        if hit and 20 * len(hit) >= len(words):
            bad.add(doc)
    assert bad and texts(steps[3]) == [x for x in texts(steps[2]) if x[0] not in bad]


def test_stage_of_near_copies_broadcasts_no_keys(spark, folder, steps, monkeypatch):
    joined, links = [], simhash.links
    monkeypatch.setattr(simhash, "links", lambda *a, **b: joined.append(links(*a, **b)) or joined[-1])
    found = corpus_pipeline.simhash_near_dedup(spark, steps[1], folder)
    assert texts(found) == texts(steps[2])
    for frame in joined:
        frame.collect()
    plans = [frame._jdf.queryExecution().executedPlan().toString() for frame in joined]
    assert plans and all("SortMergeJoin" in plan and "BroadcastExchange" not in plan for plan in plans)


def test_secrets_stage(steps):
    def masked(text):
        out, at = [], 0
        for _, a, b in brute_base(text):
            if a >= at:
                out += [text[at:a], "[secret]"]
            at = max(at, b)
        return "".join([*out, text[at:]])

    before = texts(steps[3])
    assert any(brute_base(t or "") for _, t in before)
    assert texts(steps[4]) == sorted(((d, None if t is None else masked(t)) for d, t in before), key=str)
    assert all(r.n_chars == len(r.text) for r in steps[4].where("text like '%[secret]%'").collect())


def test_mixing_stage(steps, tmp_path):
    steps[4].select("doc_id", "text", "source").toPandas().to_parquet(tmp_path / "d.parquet")
    db = duckdb.connect()
    db.execute(f"create view documents as select * from '{tmp_path}/d.parquet'")
    want = db.sql(f"select doc_id, sum(taken) from ({catalog.mixing_sql()}) where taken > 0 group by doc_id").fetchall()
    assert sorted(((r.doc_id, r.taken) for r in steps[5].collect()), key=str) == sorted(want, key=str)


def test_run_is_all_stages(spark, folder, steps):
    again = corpus_pipeline.run(spark, folder)
    assert sorted(again.columns) == sorted(steps[5].columns)
    key = ["doc_id", "text", "taken"]
    assert sorted(map(str, again.select(key).collect())) == sorted(map(str, steps[5].select(key).collect()))
