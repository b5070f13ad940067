"""Token files: ids against whole-text encoding, exact round trips, random access without copies."""

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tillmark.llm import catalog, tokenfiles

VOCABULARY = public_tokenizers.path(tokenfiles.VOCABULARY)


@pytest.fixture(scope="module")
def whole():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    return lambda text: tokenizer.encode(text or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def encoder():
    return tokenfiles.Encoder(VOCABULARY)


ODD = [
    "", " ", "\n\n", "Don't you're I'LL 'Sx x's", "naïve café e ́x", "İstanbul ΣΊΣΥΦΟΣ ς", "word,.;next word,. ;", "a<|endoftext|>b <|startoftext|>",
    "<|endof text|>", "tab\tand\x0bvt\x1cfs\x85nel nbsp em　id", "한국어 각 각", "12.5km² ½ x²y", "😀👩‍👩‍👧 ok!!", "x" * 3000, "À×Ö÷ß ÿŸ", "a!b? c:d; e,", "́lead",
    "don’t it's.", "ﬁ ligature Ⅷ ẞ", "null\x00byte", "<|ENDOFTEXT|> x", "A<|endoftext|>, b", "end.\r\nnext\r",
]


def test_ids_are_those_of_whole_texts(encoder, whole):
    for text, packed in zip(ODD, encoder.encode([t.encode() for t in ODD])):
        assert np.frombuffer(packed, encoder.kind).tolist() == whole(text), repr(text)
    assert encoder.encode([None]) == [b""]


@settings(max_examples=300, deadline=None)
@given(st.text(st.one_of(st.sampled_from(" \n\t.,'!aZéß́<|>s"), st.characters(codec="utf-8")), max_size=40))
def test_any_text(encoder, whole, text):
    assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.kind).tolist() == whole(text)


def test_pieces_at_hand_are_bounded(encoder, whole, monkeypatch):
    monkeypatch.setattr(tokenfiles, "PIECES_AT_HAND", 5)
    for text in ["one two three four, five", "six seven. eight", "one two"]:
        assert np.frombuffer(encoder.encode([text.encode()])[0], encoder.kind).tolist() == whole(text)
        assert len(encoder.known) <= 12


def test_blocks_of_texts(whole):
    """Ids of a slice of texts at once; words are learnt without the marks around them, so few pieces differ."""
    fresh = tokenfiles.Encoder(VOCABULARY)
    texts = ["one-two, ONE! (one) it's", None, "", "one", "-two", "a.<|endoftext|>, One.two", " \n", "two", "two%%% one"]
    ids, ends = fresh.encode_block(pa.array(["left out", *texts, "too"]).slice(1, len(texts)))
    got = [part.tolist() for part in np.split(ids, ends)]
    assert got == [*map(whole, texts), []]
    assert {b"one", b"-two", b"%%%"} <= fresh.known.keys() and not any(k.startswith((b"one-", b"one!", b"two%")) for k in fresh.known)
    ids, ends = fresh.encode_block(pa.array([None, ""]))
    assert (len(ids), ends.tolist()) == (0, [0, 0])


def expected(rows, whole):
    """Rows in order of ids; those of one id in any order."""
    found, start = {}, 0
    for doc_id, text in rows:
        ids = [*whole(text), 1]
        found.setdefault(doc_id, []).append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    return found


def check(got, rows, whole):
    want = expected(rows, whole)
    got = sorted(got, key=lambda r: r["start"])
    start = 0
    for r in got:
        assert r["start"] == start
        start += r["n_tokens"]
        want[r["doc_id"]].remove((r["n_tokens"], r["ids_crc32"]))
    assert not any(want.values())
    ids = [r["doc_id"] for r in got]
    assert ids == sorted(ids, key=lambda i: (i is None, i or 0))


def test_query_matches_whole_texts(spark, whole):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in catalog.table(spark, sf, "documents").select("doc_id", "text").collect()]
    df = catalog.op13_token_files(spark, sf)
    assert df.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and {t for _, t in df.dtypes} == {"bigint"}
    check(df.collect(), rows, whole)


def test_nulls_repeats_long_texts_and_clashing_columns(spark, whole):
    rows = [(5, "five"), (None, "no id"), (3, None), (3, ""), (3, "three"), (3, "three"), (-1, "long " * 60_000), (7, "x"), (2, "Two, too. " * 3)] + [(9, "same text")] * 50
    df = spark.createDataFrame([(i, t, 1, "p") for i, t in rows], "doc_id bigint, text string, start int, k0 string").repartition(4)
    check(tokenfiles.write_and_read(spark, df).collect(), rows, whole)
    assert tokenfiles.write_and_read(spark, spark.createDataFrame([], "doc_id bigint, text string")).collect() == []
    named = spark.createDataFrame([("b", "x y"), ("a", "z")], "doc_id string, text string")
    assert [(r["doc_id"], r["start"]) for r in sorted(tokenfiles.write_and_read(spark, named).collect())] == [("a", 0), ("b", 2)]


def test_one_id_fills_several_shards(spark, tmp_path):
    rows = [(1, f"text {k % 3}") for k in range(400)]
    manifest = tokenfiles.write_shards(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), str(tmp_path), VOCABULARY)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        again = tokenfiles.write_shards(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4), str(tmp_path / "b"), VOCABULARY).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(again) > 1 and sum(r["n_docs"] for r in again) == 400 == sum(r["n_docs"] for r in manifest.collect())
    assert [r["first_id"] for r in sorted(again)] == np.cumsum([0, *[r["n_ids"] for r in sorted(again)][:-1]]).tolist()


@pytest.mark.parametrize("n", [0, 1, 7, 8, 9, 16, 40, 41])
def test_sequences_round_trip(tmp_path, n):
    ids = np.arange(n, dtype="<u2")
    path = str(tmp_path / "x.ids.arrow")
    with pa.OSFile(path, "wb") as sink:
        writer = tokenfiles.ShardWriter(sink, ids.dtype, sequence=4, per_batch=2)
        for k in range(0, n, 3):
            writer.add(ids[k : k + 3].tobytes())
        writer.close()
    before = pa.total_allocated_bytes()
    with tokenfiles.open_input(f"file://{path}") as source:
        found = tokenfiles.Sequences(source)
        assert len(found) == -(-n // 4)
        for k in range(len(found)):
            values, mask = found[k]
            real = ids[4 * k : 4 * k + 4]
            assert values.tolist() == [*real, *[0] * (4 - len(real))] and mask.to_pylist() == [True] * len(real) + [False] * (4 - len(real))
            assert not values.flags.owndata
        assert pa.total_allocated_bytes() == before  # views of the mapped file
        assert np.concatenate([ids[:0], *found.pieces()]).tolist() == ids.tolist()
        with pytest.raises(IndexError):
            found[len(found)]


def test_batches_have_one_size(tmp_path):
    path = str(tmp_path / "y.ids.arrow")
    with pa.OSFile(path, "wb") as sink:
        writer = tokenfiles.ShardWriter(sink, np.dtype("<u2"), sequence=4, per_batch=2)
        writer.add(np.arange(50, dtype="<u2").tobytes())
        writer.close()
    with pa.memory_map(path) as source:
        file = pa.ipc.open_file(source)
        assert [file.get_batch(k).num_rows for k in range(file.num_record_batches)] == [2, 2, 2, 2, 2, 2, 1]
        assert file.schema.field("ids").type == pa.list_(pa.uint16(), 4)
