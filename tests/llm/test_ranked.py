import tempfile
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stellate.llm.ranked import WordEncoder, decode_ranks, encode_ranks, read_ids, round_trip, write_ids
from tests.llm.helpers import corpus, frame

PATH = public_tokenizers.path("word_bpe_49k.json")


@given(st.lists(st.integers(0, (1 << 32) - 1) | st.integers(0, 300), max_size=200))
@settings(max_examples=150, deadline=None)
def test_codes_round_trip(values):
    ranks = np.array(values, np.uint32)
    control, data = encode_ranks(ranks)
    assert len(control) == -(-len(values) // 4)
    assert len(data) == sum(max(1, (v.bit_length() + 7) // 8) for v in values)
    assert decode_ranks(control, data, len(values)).tolist() == values


@given(st.lists(st.text(max_size=50), min_size=1, max_size=6))
@settings(max_examples=150, deadline=None)
def test_any_text_as_the_library(texts):
    library = Tokenizer.from_file(PATH)
    encoder = WordEncoder(PATH)
    for ids, e in zip(encoder.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert np.frombuffer(ids, encoder.dtype).tolist() == e.ids


def test_files_hold_every_id_in_order(spark):
    docs = corpus()
    rows = sorted(map(tuple, round_trip(frame(spark, docs), PATH).collect()))
    library, at, expect = Tokenizer.from_file(PATH), 0, []
    for i, ids in sorted((i, library.encode(t or "", add_special_tokens=False).ids + [1]) for i, t in docs):
        expect.append((i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert rows == expect


def test_ids_come_back(spark):
    path = tempfile.mkdtemp(prefix="stellate-ids-") + "/ids"
    write_ids(frame(spark, [(2, "b a"), (1, "a a a"), (None, None)]), PATH, path)
    library = Tokenizer.from_file(PATH)
    got = {r["doc_id"]: (r["start"], r["ids"]) for r in read_ids(spark, path, with_ids=True).collect()}
    a, b = library.encode("a").ids, library.encode("b").ids
    assert got == {None: (0, [1]), 1: (1, a * 3 + [1]), 2: (5, b + a + [1])}
    ranks = {r["id"]: r["rank"] for r in spark.read.parquet(f"{path}/ranks").collect()}
    assert ranks == {a[0]: 0, 1: 1, b[0]: 2}


def test_empty_table(spark):
    assert round_trip(frame(spark, []), PATH).count() == 0


def test_a_hot_id_spreads_over_parts(spark, tmp_path):
    """A third of the rows under a null id, half of those equal in text too."""
    docs = [(i, f"text {i} of many") for i in range(800)] + [(None, f"other {i}") for i in range(200)] + [(None, "same")] * 200
    path = str(tmp_path / "hot")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # the parts of a large table
    try:
        write_ids(frame(spark, docs).repartition(4), PATH, path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    parts = [r["n"] for r in spark.read.parquet(f"{path}/blocks").selectExpr("part", "explode(doc_ids) AS d").groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert len(parts) > 4 and max(parts) < 400
    rows = sorted(read_ids(spark, path).collect(), key=lambda r: r["start"])
    assert [r["doc_id"] for r in rows] == [None] * 400 + list(range(800))
    assert [r["start"] for r in rows] == np.cumsum([0, *(r["n_tokens"] for r in rows)]).tolist()[:-1]
