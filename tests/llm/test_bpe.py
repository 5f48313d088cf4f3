import hashlib
import random
import sys

import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from stellate.llm.bpe import OTHER_SCRIPTS, SLICE, WORDS, BytePair, _code, encode_documents, load, token_digests
from tests.llm.helpers import corpus, frame

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def same(library, texts):
    bpe = load(PATH)
    for text, ids, e in zip(texts, bpe.encode_batch(texts), library.encode_batch(texts, add_special_tokens=False), strict=True):
        assert ids.tolist() == e.ids, text
        assert bpe.decode(ids) == library.decode(e.ids, skip_special_tokens=False) == text


@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
@settings(max_examples=150, deadline=None)
def test_any_text(texts):
    same(Tokenizer.from_file(PATH), texts)


def test_hard_texts(library):
    r = random.Random(4)
    texts = ["", "a" * 3000, "ab" * 2000, " " * 500, "aaaa aaa aa", "it's DON'T we'll", "<|endoftext|>x<|endoftext|><|endoftext|>", "a<|endoftext|", "日本語 한국어 ՘", "\x1c \x85\xa0 x\n\n y"]
    texts += ["".join(r.choice("abcdeing tho\n") for _ in range(60)) for _ in range(800)]
    same(library, texts)


def test_exact_merging_alone_agrees(library):
    """The slow path of every word, short list and heap alike."""
    bpe = load(PATH)
    for text in ("hello", "abracadabra" * 20, "mississippi", "a" * 100, "zzzyyxx" * 30):
        assert bpe.merge_exactly(text) == library.encode(text, add_special_tokens=False).ids


def test_safe_scripts_are_cut_alike(library):
    points = [c for c in [*range(1, 0x500), *range(0x2010, 0x2030), *range(0x20A0, 0x20C0), *range(0x3041, 0x30F7), *range(0x4E00, 0x4F00)] if not OTHER_SCRIPTS.search(chr(c))]
    text = "".join(f"a{chr(c)}b {chr(c)}1{chr(c)} ." for c in points)
    assert WORDS.findall(text) == [text[a:b] for _, (a, b) in library.pre_tokenizer.pre_tokenize_str(text)]


def test_digests(spark, library):
    docs = corpus()
    rows = token_digests(encode_documents(frame(spark, docs), PATH)).collect()
    assert len(rows) == len(docs)
    texts = dict(docs)
    for r in rows:
        text = texts[r["doc_id"]] or ""
        ids = library.encode(text, add_special_tokens=False).ids
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    assert token_digests(encode_documents(frame(spark, []), PATH)).count() == 0


def test_a_worker_holds_little(library):
    """A word's cached ids take few bytes, and a batch is cut into pieces before its words are made."""
    bpe, r = BytePair(PATH), random.Random(5)
    words = ["".join(r.choice("abcdefghij") for _ in range(12)) for _ in range(5000)]
    same_ids = [e.ids for e in library.encode_batch(words, add_special_tokens=False)]
    assert [x.tolist() for x in bpe.encode_batch(words)] == same_ids
    assert sum(sys.getsizeof(v) for v in bpe.cache.values()) <= 64 * len(bpe.cache)
    texts = ["word " * (SLICE // 20)] * 12
    batch = pa.RecordBatch.from_arrays([pa.array(range(12)), pa.array(texts)], names=["doc_id", "text"])
    out = list(_code(PATH, True)(iter([batch])))
    assert len(out) > 2 and sum((b.column(2).to_pylist() for b in out), []) == texts
