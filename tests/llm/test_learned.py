"""Classifiers, formats and extraction: held-out accuracy, edge cases, brute force where there is one."""

import hashlib
import html
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from tillmark.llm import automata, boosting, extract, quality, secrets, toxicity
from tillmark.llm.dom import Page

SF = "/root/testdata/sf0.01"
EDGE = [(0, None), (1, ""), (2, " \n\t"), (3, "one"), (None, "no id here."), (3, "one"), (2**60 + 1, "x " * 50000)]
SCHEMA = "doc_id bigint, text string, score string, label string, x string"


def edge(spark):
    return spark.createDataFrame([(d, t, "clash", "clash", "clash") for d, t in EDGE], SCHEMA)


def area(score, label):
    order = np.argsort(score, kind="stable")
    rank = np.empty(len(order))
    rank[order] = np.arange(1, len(order) + 1)
    p = label.sum()
    return (rank[label == 1].sum() - p * (p + 1) / 2) / (p * (len(label) - p))


@pytest.mark.parametrize(("name", "mark", "least"), [("op1_quality", "quality", 0.98), ("op8_toxicity", "toxic", 0.75)])
def test_held_out_accuracy(spark, name, mark, least):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    found = contract.queries()[name](spark, SF)
    assert found.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    rows = found.join(labels, "doc_id").toPandas()
    assert all((zlib.crc32(str(d).encode()) % 4 == 2) == h for d, h in zip(rows["doc_id"], rows["held_out"]))
    assert rows["score"].between(0, 1).all()
    unseen = rows[rows["held_out"]]
    assert area(unseen["score"].to_numpy(), unseen[mark].to_numpy()) >= least


@pytest.mark.parametrize(("scores", "mark"), [(quality.quality_scores, "quality"), (toxicity.toxicity_scores, "toxic")])
def test_scores_of_edge_cases(spark, scores, mark):
    docs = edge(spark)
    no_labels = spark.createDataFrame([], f"doc_id bigint, {mark} int")
    odd_labels = spark.createDataFrame([(3, 1), (3, 1), (None, 0), (1, None), (2, 7), (0, 0)], f"doc_id bigint, {mark} int")
    for labels in (no_labels, odd_labels):
        rows = scores(docs, labels).collect()
        assert sorted(str(r.doc_id) for r in rows) == sorted(str(d) for d, _ in EDGE)
        assert all(0 <= r.score <= 1 and r.predicted in (0, 1) for r in rows)
        assert len({r.score for r in rows if r.doc_id == 3}) == 1
    assert scores(docs.where("false"), odd_labels).collect() == []


def test_good_documents_stay(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    kept = quality.keep_good(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    truth = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([d in ids for d, q in truth.items() if q == 1]) > 0.97
    assert np.mean([d in ids for d, q in truth.items() if q == 0]) < 0.05


def test_discriminant_matches_dense_formula(spark):
    rng = np.random.default_rng(1)
    d = len(quality.STATISTICS)
    x = np.vstack([rng.normal(0, 1, (40, d)), rng.normal(1, 2, (60, d))])
    y = [0] * 40 + [1] * 60
    rows = spark.createDataFrame([(i, [float(v) for v in row], k) for i, (row, k) in enumerate(zip(x, y))], "doc_id bigint, x array<double>, label int")
    model = quality.fit(rows)
    covariances = []
    pooled = sum(np.cov(x[np.array(y) == k].T) * (y.count(k) - 1) for k in (0, 1)) / 98
    for k in (0, 1):
        mixed = 0.9 * np.cov(x[np.array(y) == k].T) + 0.1 * pooled
        covariances.append(0.95 * mixed + 0.05 * np.trace(mixed) / d * np.eye(d))
    gap = 0
    for sign, k in ((-1, 0), (1, 1)):
        c = x - x[np.array(y) == k].mean(axis=0)
        gap = gap + sign * -0.5 * ((c @ np.linalg.inv(covariances[k]) * c).sum(axis=1) + np.linalg.slogdet(covariances[k])[1])
    want = 1 / (1 + np.exp(-(gap / quality.TEMPERATURE + np.log(61 / 41))))
    got = {r.doc_id: r.score for r in quality.score(rows, model).collect()}
    assert np.allclose([got[i] for i in range(100)], want)


def test_risk_and_its_slope_by_direct_evaluation():
    rng = np.random.default_rng(5)
    loss = lambda z, y: math.log1p(math.exp(-z if y else z))
    for turns, marked, others in ((False, 0.0, 1.0), (True, 8.0, -6.0)):
        z = rng.normal(size=30)
        is_p = np.arange(30) < 12
        z += np.where(is_p, marked, others)
        prior = 0.4

        def parts(z):
            positive = prior * sum(loss(v, 1) for v in z[is_p]) / 12
            return positive, sum(loss(v, 0) for v in z[~is_p]) / 18 - prior * sum(loss(v, 0) for v in z[is_p]) / 12

        kept, corrected, slope = toxicity.risk_slope(z, is_p, prior)
        assert (kept, corrected) == pytest.approx(parts(z))
        turned = corrected < -toxicity.BETA * prior
        assert turned == turns
        for i in range(30):
            step = np.eye(30)[i] * 1e-6
            (p1, c1), (p0, c0) = parts(z + step), parts(z - step)
            want = -(c1 - c0) if turned else p1 + c1 - p0 - c0
            assert slope[i] == pytest.approx(want / 2e-6, abs=1e-6)


def test_only_near_copies_leave_the_sample(spark):
    words = [f"w{k}" for k in range(400)]
    rng = random.Random(9)
    docs = [(k, " ".join(rng.sample(words, 40)), 1) for k in range(300)]
    docs += [(300 + k, docs[0][1] + " " + docs[0][1], 1) for k in range(50)]
    df = spark.createDataFrame([(i, t) for i, t, _ in docs], "doc_id bigint, text string")
    minima = [F.array_min(F.transform(F.split("text", " "), lambda w: F.xxhash64(w, F.lit(toxicity.SEED + k)))).alias(f"m{k}") for k in range(toxicity.MINIMA)]  # noqa: B023
    assert df.select(*minima).distinct().count() == 300


def test_unlabelled_risk_finds_the_positive_feature():
    rng = random.Random(1)
    positive = [[0] + [rng.randrange(1, 20)] for _ in range(100)]
    unlabelled = [([0] if rng.random() < 0.1 else []) + [rng.randrange(1, 20)] for _ in range(400)]
    w, bias = toxicity.train(positive, unlabelled, 20, 0.1)
    assert w.argmax() == 0 and bias < 0 < w[0] + bias
    assert toxicity.train([], unlabelled, 20, 0.1)[1] == pytest.approx(np.log(0.1 / 0.9))


def brute_base(text):
    assign = [("assign", *m.span()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text) if len(m.group(2)) >= 6]
    access = [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    hexes = [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m.group()) >= 24]
    return sorted(assign + access + hexes, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def credential_rows():
    rng = random.Random(2)
    token = lambda n, chars="0123456789abcdef": "".join(rng.choices(chars, k=n))
    rows = [(0, None), (1, ""), (None, f"password={token(18)}"), (2, "API_KEY: 'short' apikey=abc secret = \"with.six+\" paſſword=Key12345")]
    for i in range(3, 120):
        secret = rng.choice([f"password={token(18)}", f'Token = "{token(40)}"', "AKIA" + token(16, "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"), token(40), "AKIA" + "AKIA" * 5, "ordinary words"])
        rows.append((i, f"Ünder wörds 😀 {secret} and internationalization of telecommunications 4644348398010899 end"))
    return rows + [(7, rows[7][1]), (200, f"bare {token(18)} here, 2024-01-02T10:00:00.000 and www.averyordinaryhostname.example.com/with/a/path")]


def test_secrets(spark):
    rows = credential_rows()
    docs = spark.createDataFrame([(d, t, 5, "clash") for d, t in rows], "doc_id bigint, text string, n_chars int, spans string")
    found = secrets.find_secrets(docs).collect()
    assert sorted(((r.doc_id, [tuple(s) for s in r.base]) for r in found), key=str) == sorted(((d, brute_base(t or "")) for d, t in rows), key=str)
    bare = next(r for r in found if r.doc_id == 200)
    assert [(s.kind, s.start) for s in bare.spans] == [("format", 5)]  # 18 hex digits, too few for a fixed pattern
    assert all(not [s for s in r.spans if s.kind == "format"] for r in found if r.doc_id != 200)
    clean = {(r.doc_id, r.text, r.n_chars) for r in secrets.redact(docs).collect()}
    assert (0, None, 5) in clean and (1, "", 5) in clean and (None, "[secret]", 8) in clean
    assert not any(brute_base(t or "") for _, t, _ in clean)
    assert secrets.redact(docs).columns == docs.columns and secrets.find_secrets(docs.where("false")).collect() == []


def test_formats_come_from_all_values(spark):
    rng = random.Random(8)
    keys = sorted({"".join(rng.choices("0123456789abcdef", k=rng.choice([12, 18, 100]))) for _ in range(1_500)})
    runs = sorted({"".join(rng.choices("abcdefghijklmnopqrstuvwxyzABCDEF/.-", k=rng.randint(17, 90))) for _ in range(6_000)})
    rows = [(i, f"password={keys[i % len(keys)]} and {run}") for i, run in enumerate(runs)]
    formats = secrets.fit(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert set(formats.automata) >= {"assign"}
    automaton, least = formats.automata["assign"]
    assert sum(automaton.ended) == len(keys) and sum(automaton.passed) == sum(len(k) + 1 for k in keys)
    gains = [formats.gain(automaton, k) for k in keys]
    assert least == pytest.approx(max(secrets.LEAST_GAIN, np.quantile(gains, secrets.LOWEST_SHARE)))
    steps = sum((automata.chain_steps(automata.symbols(r)) for r in runs), Counter())
    assert np.array_equal(formats.ordinary.bits, automata.Background(steps).bits)


def test_prefix_counts_give_the_automaton_of_their_values():
    rng = random.Random(3)
    values = sorted({"".join(rng.choices("0123456789abcdef", k=rng.choice([6, 9]))) + "-Zz" * rng.randint(0, 2) for _ in range(200)})
    paths = ["".join(map(str, automata.symbols(v))) for v in values]
    passed = Counter(p[:k] for p in paths for k in range(len(p) + 1))
    whole = automata.infer_from_prefixes([(p, n, paths.count(p)) for p, n in passed.items()], 1)
    plain = automata.infer(values)
    assert all(whole.log_likelihood(v) == pytest.approx(plain.log_likelihood(v)) for v in [*values, "internationalization"])
    for tree in (whole, automata.infer_from_prefixes([(p, n, paths.count(p)) for p, n in passed.items()], 5)):
        steps = Counter()
        for path in paths:
            tree.walk([int(s) for s in path], 1, steps)
        counted = tree.counted((*step, n) for step, n in steps.items())
        assert sum(counted.ended) == len(values) and sum(counted.passed) == sum(len(v) + 1 for v in values)


def test_secret_digests(spark):
    rows = {r.doc_id: r for r in contract.queries()["op10_secrets"](spark, SF).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}
    assert rows.keys() == texts.keys()
    for doc, text in texts.items():
        base = ",".join(f"{k}:{a}:{b}" for k, a, b in brute_base(text or ""))
        assert rows[doc].base_sha256 == hashlib.sha256(base.encode()).hexdigest() and base in rows[doc].spans


def test_automaton_learns_a_format():
    rng = random.Random(1)
    values = ["".join(rng.choices("0123456789abcdef", k=rng.choice([18, 40]))) for _ in range(300)]
    learnt = automata.infer(values)
    assert learnt.passed[0] >= 300 and learnt.merge() is learnt
    bits = lambda v: learnt.log_likelihood(v) / len(v)
    assert bits("0f3a9c12be7745d0aa") > bits("internationalizati") + 1
    assert automata.infer([]).log_likelihood("abc") < 0 and automata.infer([""]).ended[0] == 1


def brute_decode(parent, odds):
    best = (0.0, (False,) * len(odds))
    for bits in range(2 ** len(odds)):
        labels = tuple(bool(bits >> i & 1) for i in range(len(odds)))
        if all(not labels[i] or p < 0 or labels[p] for i, p in enumerate(parent)):
            best = max(best, (sum(o for o, x in zip(odds, labels) if x), labels))
    return list(best[1])


def test_decoding_is_the_best_consistent_labelling():
    rng = random.Random(4)
    for _ in range(60):
        n = rng.randint(1, 9)
        parent = [-1] + [rng.randrange(i) for i in range(1, n)]
        odds = [rng.gauss(0, 2) for _ in range(n)]
        assert extract.decode(parent, odds) == brute_decode(parent, odds)


def test_boosting_separates():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(800, 5))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    assert ((boosting.fit(x, y).log_odds(x) > 0) == y).mean() > 0.97
    assert boosting.fit(np.zeros((0, 3)), np.zeros(0)).log_odds(np.zeros((2, 3))).shape == (2,)


def test_reader_of_broken_pages():
    runs = lambda s: [t for t in Page(s).text if t]
    assert runs("<p>a<p>b &amp; c&nbsp; d<br>e</p><!-- x > y -->f") == ["a", "b & c d e", "f"]
    assert runs("<script>var a='</p>';</script><style>p{}</style><title>t</title>x<") == ["x<"]
    assert runs("<ul><li>1<li>2<ul><li>3</ul><li>4</ul><p class='a>b'>q</p></div>r<p unfinished") == ["1", "2", "3", "4", "q", "r"]
    assert runs("") == [] and runs("<html><head><title>x</title><p>no closing head</p>") == ["no closing head"]
    assert runs("<html><head><meta charset=x><title>t</title>text at once<body><p>b") == ["text at once", "b"]
    assert runs("<p>a<svg><title>i</title><text>drawn</text><path d=x/>") == ["a"]
    assert runs("<div><p>a<svg><g><text>drawn</p><p>b</p></div><p>c") == ["a", "b", "c"]
    assert runs("<p>one<svg viewBox=x/> two <svg><text>no</text></svg>three</p>") == ["one two three"]
    for media in ("video", "audio", "object", "canvas"):
        assert runs(f"<article><p>a</p><{media} src=x>fallback<p>b</p></article><p>c") == ["a", "fallback", "b", "c"]
    assert runs("<p>let <math><mi>x</mi><mo>=</mo><mn>1</mn></math> hold</p>") == ["let x=1 hold"]
    assert runs("<p>super<wbr>cali <i>frag</i>il<img src=x>istic a<br>b</p><hr>c") == ["supercali fragilistic a b", "c"]
    assert runs("<p>a<noscript>no<p>b</p><iframe><p>c") == ["ano", "b", "c"]
    assert runs("<p>x <my-tag>y</my-tag> <ruby>z<rt>w</rt></ruby></p>") == ["x y zw"]
    assert runs("<div><b>bold</b> and <a href=x>link</a></div>") == ["bold and link"]


def article_text(source):
    """The article of a well-formed page, by patterns alone."""
    body = re.search(r"<article>(.*)</article>", source, re.S)[1]
    body = re.sub(r"<!--.*?-->", "", body, flags=re.S)
    blocks = re.split(r"</?(?:p|h[1-6]|ul|ol|li|div|blockquote|table|tr|td)\b[^>]*>", body)
    texts = [" ".join(html.unescape(re.sub(r"<br/?>", " ", b)).split()) for b in (re.sub(r"</?(?:a|b|i|em|strong|span)\b[^>]*>", "", b) for b in blocks)]
    return "\n".join(t for t in texts if t)


def test_extraction(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    found = {r.page_id: r for r in extract.main_text(pages).collect()}
    for page in pages.collect():
        want = article_text(page.html)
        assert found[page.page_id].text == want and found[page.page_id].n_chars == len(want)


def test_pages_long_repeated_and_beside_clashing_columns(spark):
    sentence = "The harbour froze over in the second week, and the boats stayed at the quay until March came. "
    long = "<body><nav><a href=/>Home</a></nav><article><h1>Ice</h1>" + f"<p>{sentence * 4}</p>" * 6000 + "</article><footer>&copy; x</footer>"
    open_head = f"<html><head><title>t</title><article><h1>Ice</h1><p>{sentence * 3}<svg><path d=m><p>{sentence * 2}</article>"
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame([(9001, "u", long), (9002, "u", open_head), (9002, "u", open_head)], "page_id bigint, url string, html string")
    pages = given.unionByName(extra).withColumns({"text": F.lit("clash"), "n_chars": F.lit(-1)})
    got = sorted((r.page_id, r.text, r.n_chars) for r in extract.main_text(pages).where("page_id > 9000").collect())
    block = lambda n: (sentence * n).strip()
    opened = f"Ice\n{block(3)}\n{block(2)}"
    whole = "\n".join(["Ice", *[block(4)] * 6000])
    assert got == [(9001, whole, len(whole)), (9002, opened, len(opened)), (9002, opened, len(opened))]


def test_other_layouts(spark):
    paragraph = "Rain fell on the plain for three days, and the river rose over its banks. People moved their goods uphill. " * 3
    page = (
        "<body><div class='cookie-notice'><p>We use cookies on this site, and you agree.</p></div><div id=nav><a href=/>Home</a> <a href=/n>News</a></div>"
        f"<div class='post-content'><h1>Flood</h1><p>{paragraph}</p><form><label>Search</label><input></form><p>{paragraph}</p>"
        f"<div class='advert'>Buy now!</div></div><div class='sidebar'><p>{paragraph}</p></div>"
        f"<section id='comments'><h2>Comments</h2><p>{paragraph}</p></section><div class='footer'>&copy; 2024</div></body>"
    )
    given = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url", "html")
    extra = spark.createDataFrame([(9001, None, page), (9002, "u", None), (9003, "u", ""), (None, "u", "<div></div>")], "page_id bigint, url string, html string")
    got = {r.page_id: r.text for r in extract.main_text(given.unionByName(extra)).where("page_id > 9000 or page_id is null").collect()}
    once = " ".join(paragraph.split())
    assert got == {9001: f"Flood\n{once}\n{once}", 9002: "", 9003: "", None: ""}
    assert extract.main_text(given.where("false")).collect() == []
