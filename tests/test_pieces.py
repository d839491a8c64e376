"""Pieces against a plain search, and back to words."""

import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidecast.operators import pieces

TEXTS = [(1, "the cat and the catalogue"), (2, "cat the  unthecat"), (3, None), (4, ""), (5, "Zebra the the"), (6, "é x")]


@pytest.fixture(scope="module")
def known(spark):
    df = spark.createDataFrame(TEXTS, "id int, content string")
    return {r["piece"]: r["piece_id"] for r in pieces.build_pieces(df, 3).collect()}


def test_the_vocabulary_has_all_characters_and_the_most_frequent_words(known):
    letters = {c for _, t in TEXTS for c in (t or "").lower() if c != " "}
    assert set(known) == letters | {"the", "cat", "and"}
    assert sorted(known.values()) == list(range(3, 3 + len(known)))
    assert max(known[c] for c in letters) < min(known[w] for w in ("the", "cat", "and"))


def test_the_longest_known_piece_comes_first(known):
    n, longest = len(known), max(map(len, known))
    assert pieces.cut("the", known, longest) == [known["the"]]
    assert pieces.cut("thecat", known, longest) == [known["the"], known["cat"] + n]
    assert pieces.cut("acat", known, longest) == [known["a"], known["cat"] + n]
    assert pieces.cut("ca", known, longest) == [known["c"], known["a"] + n]
    assert pieces.cut("c?a", known, longest) == [known["c"], 1, known["a"] + n]


def test_texts_come_back_from_their_ids(spark, known):
    df = spark.createDataFrame(TEXTS, "id int, content string").repartition(3)
    vocabulary = pieces.build_pieces(df, 3)
    names = {i: p for p, i in known.items()}
    got = {r["id"]: r for r in pieces.encode_pieces(df, "id", vocabulary, 32).collect()}
    for key, text in TEXTS:
        ids, mask = got[key]["input_ids"], got[key]["attention_mask"]
        assert len(ids) == len(mask) == 32 and mask == [int(i != 0) for i in ids]
        assert pieces.words_of(ids, names) == (text or "").lower().split()
    short = {r["id"]: r["input_ids"] for r in pieces.encode_pieces(df, "id", vocabulary, 4).collect()}
    assert all(short[k] == got[k]["input_ids"][:4] for k in short)
    with pytest.raises(ValueError):
        pieces.encode_pieces(df, "id", vocabulary, most=3)


def test_pairs_keep_their_pieces_and_the_first_text_gives_way(spark, known):
    df = spark.createDataFrame([(1, "the " * 50, "cat and"), (2, "the", None), (3, None, "and " * 50)], "id int, content string, pair string")
    got = {r["id"]: r["input_ids"] for r in pieces.encode_pieces(df, "id", spark.createDataFrame(list(known.items()), "piece string, piece_id long"), 8, pair_col="pair").collect()}
    the, cat, and_ = (known[w] for w in ("the", "cat", "and"))
    assert got[1] == [the] * 5 + [2, cat, and_]
    assert got[2] == [the, 2] + [0] * 6
    assert got[3] == [2] + [and_] * 7


def test_a_query_encodes_every_text_without_unknown_ids(spark, sf_dir):
    from tidecast.plans import catalog

    rows = catalog.QUERIES["encode_subwords"](spark, sf_dir)
    assert rows.count() == rows.select("doc_id").distinct().count() == spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    assert rows.where(F.array_contains(F.split("input_ids", " "), "1")).count() == 0


def test_a_large_batch_is_encoded_a_few_texts_at_a_time():
    words = [[f"{'cat' * (k % 3)}{k % 7}" for k in range(400)] for _ in range(4000)]
    batch = pa.RecordBatch.from_pydict({"id": pa.array(range(4000)), "_first": words, "_second": pa.array([None] * 4000, pa.list_(pa.string()))})
    types = pa.schema([("id", pa.int64()), ("input_ids", pa.list_(pa.int64())), ("attention_mask", pa.list_(pa.int64()))])
    run = pieces._encoder({c: k + 3 for k, c in enumerate("cat0123456")}, types, 512, False)
    tracemalloc.start()
    rows = sum(part.num_rows for part in run([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 4000 and peak < 32 << 20
