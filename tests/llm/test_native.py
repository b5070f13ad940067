"""The native operators beside their SQL on a fixture of edge cases, and on the tables."""

import random

import duckdb
import pyarrow as pa
import pytest

import __spark_entry__ as contract
from check_oracle import sorted_rows
from tillmark.llm import catalog, decontaminate, linerules, mixing, urlrules

NAMES = sorted(catalog.oracles())


def documents():
    rng = random.Random(5)
    words = ["The", "of", "Ärger", "stone.", "river,", "x1", "日本", "😀", "was", "there!", "a|b", "tion"]
    text = lambda k, sep=" ": sep.join(rng.choices(words, k=k))
    rows = [(0, None), (1, ""), (2, " \n\t \x0b"), (3, "one"), (4, "x " * 3000), (5, "Home\nMenu\nhome | next | previous | login\n" * 9)]
    rows += [(i, "\n".join(text(rng.randint(0, 25)) for _ in range(rng.randint(1, 8)))) for i in range(6, 60)]
    rows += [(60, "same line here.\n" * 5 + "\n\n same line here.\nother"), (61, "a b c d e f a b c d e"), (62, "a b c d e f g h i j a b c d e f"), (63, "!!! ??? ### 1 2 3 4 5 6 7 8 9 10.")]
    rows += [(10, rows[10][1]), (None, rows[12][1]), (None, None), (64, "long " * 20000 + "end."), (65, "A\x1cB\x85C\u00a0D \u2003E f g h i j k l.")]
    sources = ["src1", "src0", None, "", "Ünder", "z", "src1", "src1"]
    return [(d, t, "en", sources[(d or 0) % len(sources)], None, "clash", "clash") for d, t in rows]


def benchmark(docs):
    by_id = {d[0]: d[1] for d in docs}
    long = (by_id[20] or "") + " " + (by_id[21] or "")
    return [(1, long), (2, "x1"), (3, None), (4, "..."), (5, "never seen words anywhere in here"), (None, "stone river"), (2, "tion of"), (7, "the " * 30), (8, "x " * 14)]


def pages():
    urls = [
        None, "", "no scheme", "http://", "http://example.org", "https://Example.ORG/es/1", "http://www.example.org/es/", "http://xexample.org/es/1",
        "http://a.b.example.org/en/12", "http://example.org/en/2?x=://", "http://fr.com/fr/#a", "http://fr.com/FR/", "http://com/de/x", "http://com",
        "//x.org/a", "a://b://c.org/d", "http://example.org:80/es/", "http://é.org/é", "http://.org/", "http://example.org/es/\n/x", "http://com/de/x",
    ]
    return [(i, u, None) for i, u in enumerate(urls)] + [(0, "http://com/de/x", None), (None, "http://q.org/", None)]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    docs = documents()
    base = tmp_path_factory.mktemp("edge")
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, words string, digest string"
    for name, rows, kinds in (
        ("documents", docs, schema),
        ("benchmark", benchmark(docs), "item_id bigint, text string"),
        ("pages", pages(), "page_id bigint, url string, html string"),
    ):
        spark.createDataFrame(rows, kinds).repartition(3).write.parquet(f"{base}/{name}.parquet")
        spark.createDataFrame([], kinds).write.parquet(f"{base}/none/{name}.parquet")
    return str(base)


def compare(spark, name, sf_dir, pattern):
    db = duckdb.connect()
    for table in ("documents", "benchmark", "pages"):
        db.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet{pattern}'")
    df = contract.queries()[name](spark, sf_dir)
    result = db.sql(catalog.oracles()[name])
    assert sorted(df.columns) == sorted(result.columns)
    assert sorted_rows(df.columns, df.collect()) == sorted_rows(result.columns, result.fetchall())


@pytest.mark.parametrize("name", NAMES)
def test_edge_cases_match_sql(spark, folder, name):
    compare(spark, name, folder, "/*.parquet")


@pytest.mark.parametrize("name", NAMES)
def test_tables_match_sql(spark, name):
    compare(spark, name, "/root/testdata/sf0.001", "")


@pytest.mark.parametrize("name", NAMES)
def test_empty_tables(spark, folder, name):
    assert contract.queries()[name](spark, f"{folder}/none").collect() == []


def test_no_python_and_no_cross_joins(spark, folder):
    for name in NAMES:
        plan = contract.queries()[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
        assert not any(word in plan for word in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop")), name


def test_targets_by_water_filling(spark):
    rng = random.Random(3)
    for _ in range(3):
        sizes = {f"s{i:02d}": rng.choice([0, 1, 5, 50, 1000, 7]) for i in range(rng.randint(1, 9))} | {None: rng.randint(0, 40)}
        names = sorted((n for n in sizes if n is not None)) + [None]
        weight = {n: i % 3 + 1 for i, n in enumerate(names)}
        target, total = dict.fromkeys(names, 0.0), sum(sizes.values())
        open_names = set(names)
        while True:  # share, cap, share again what is left
            left = total - sum(target[n] for n in names if n not in open_names)
            share = {n: left * weight[n] / sum(weight[m] for m in open_names) for n in open_names}
            full = {n for n in open_names if share[n] > 3 * sizes[n]}
            if not full:
                target |= share
                break
            target |= {n: 3.0 * sizes[n] for n in full}
            open_names -= full
        got = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size bigint")).collect()
        assert {r.source: r.target for r in got} == pytest.approx(target)


def test_mix_comes_near_targets(spark):
    rows = [(i, "w " * (1 + i % 50), f"s{i % 3 if i % 2 else 0}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    out = mixing.mix(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect()
    assert all(abs(r["sum(taken)"] - r["max(target)"]) <= 200 for r in out)
    whole = mixing.mixed_documents(docs)
    assert whole.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    assert whole.selectExpr("sum(taken)").first()[0] == sum(1 + i % 50 for i in range(3000))


def test_near_items(spark):
    docs = spark.createDataFrame([(1, "alpha beta gamma delta"), (2, "gamma x alpha beta"), (3, "alpha only")], "doc_id bigint, text string")
    items = spark.createDataFrame([(9, "alpha gamma")], "item_id bigint, text string")
    got = {r.doc_id: (r.n_items, r.n_near_items) for r in decontaminate.contamination(docs, items).collect()}
    assert got == {1: (0, 1), 2: (0, 1), 3: (0, 0)}
    dirty = spark.createDataFrame([(1, "alpha gamma"), (1, "clean"), (2, "clean"), (None, "alpha gamma"), (None, "clean")], "doc_id bigint, text string")
    assert [r.doc_id for r in decontaminate.drop_contaminated(dirty, items).collect()] == [2]


def test_lines_are_cleaned(spark):
    text = "This line has many words and a proper end.\nHome | News | About | Contact\nThis one is licensed under the MIT License.\nno end here"
    row = linerules.judge_lines(spark.createDataFrame([(1, text)], "doc_id bigint, text string")).first()
    assert row.cleaned == "This line has many words and a proper end." and not row.kept and row.n_failing_lines == 3


def test_rules_with_quotes(spark):
    rules = urlrules.rules_table(spark, (("block", "o'x.org", "/\\a"),))
    pages = spark.createDataFrame([(1, "http://o'x.org/\\ab")], "page_id int, url string")
    assert urlrules.judge_urls(pages, rules).first().verdict == "block"


def test_schema_of_results(spark, folder):
    assert pa.__version__ and contract.queries()["op5_url_filter"](spark, folder).columns == ["page_id", "host", "path", "rule", "verdict"]
