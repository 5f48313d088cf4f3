"""Fill-in-middle against a brute-force version over code points, and its round trip."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stellate.llm import infill
from tests.llm.helpers import corpus, frame


def brute(doc_id, text):
    """The contract, token by token."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    n = len(units)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[i : i + 8], 16) for i in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return n, "plain", None, None, text
    if h4 % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(st.sampled_from("abZ z[`@{é中𝄞\x00\x7f<PSM>\n") | st.characters(codec="utf-8"), max_size=40), max_size=8), st.integers(0, 10**6))
def test_batches_like_brute_force(texts, first):
    ids = [str(first + i) for i in range(len(texts))]
    made = infill.transform([t.encode() for t in texts], ids)
    assert made == [brute(i, t) for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("block", [1, 2, 3, 1 << 17])
def test_blocks_look_ahead(block, monkeypatch):
    monkeypatch.setattr(infill, "BLOCK_WORDS", block)
    text = "ab cdefgh ijklmnopq, é中𝄞 rstuvwxyz" * 20
    assert infill.transform([text.encode()] * 5, list("12345")) == [brute(i, text) for i in "12345"]


def test_rank_and_select():
    words = np.frombuffer("aé b c中d.ef".encode() + bytes(16 - 15 % 8), "u1")
    words = np.frombuffer(words.tobytes()[: len(words) // 8 * 8], "<u8")
    marks = infill.Marks(infill.unit_ends(words))
    flat = np.flatnonzero(infill.unit_ends(words).view("u1"))
    assert marks.select(np.arange(1, len(flat) + 1)).tolist() == flat.tolist()
    at = np.arange(len(words) * 8 + 1)
    assert marks.rank(at).tolist() == [int((flat < i).sum()) for i in at]


def test_documents(spark):
    docs = corpus() + [(None, "no id here"), (700, "a<P>b"), (701, "<S"), (702, "\x00"), (703, "x" * 3_000_000), (704, "é" * 1_000_000 + "<")]
    made = infill.fill_in_middle(frame(spark, docs))
    rows = made.withColumn("back", infill.restored(made.form, made.output)).collect()
    want = sorted((str(i), *map(str, brute(i, t)), t or "") for i, t in docs)
    assert sorted((str(r.doc_id), str(r.n), r.form, str(r.prefix_chars), str(r.middle_chars), r.output, r.back) for r in rows) == want
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_empty_table(spark):
    out = infill.infill_digests(infill.fill_in_middle(frame(spark, [])))
    assert out.count() == 0 and out.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
