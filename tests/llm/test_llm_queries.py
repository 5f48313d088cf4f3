"""The registered queries over a whole given folder, against SQL or brute force."""

import hashlib
import html
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from stellate.llm.queries import ORACLE, QUERIES
from stellate.llm.urls import RULES, split_url
from tests.llm.test_lbl import brute as base_scores
from tests.llm.test_licenses import brute as licenses

SF = "/root/testdata/sf0.001"
NAME = {int(re.match(r"op(\d+)_", n)[1]): n for n in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "labels", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def run(spark, n):
    return QUERIES[NAME[n]](spark, SF)


def test_all_thirteen():
    assert sorted(NAME) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLE[name])
    columns = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(columns)
    # the engines may sum components in another order: distances agree to twelve digits
    bag = lambda rows: Counter(tuple(float(f"{v:.12g}") if isinstance(v, float) else v for v in r) for r in rows)
    assert bag(df.select(columns).collect()) == bag(want.fetchall())


def test_main_text(spark, con):
    rows = {r["page_id"]: r for r in run(spark, 1).collect()}
    pages = con.execute("SELECT page_id, html FROM pages").fetchall()
    assert len(rows) == len(pages)
    for i, source in pages:
        body = source[source.index("<article>") + 9 : source.rindex("</article>")]
        blocks = [" ".join(html.unescape(re.sub(r"</?b>", "", x.replace("<br>", " "))).split()) for x in re.split(r"</?(?:h1|p)>", body)]
        assert rows[i]["text"] == " ".join(b for b in blocks if b) and rows[i]["n_chars"] == len(rows[i]["text"])


def test_quality_agrees_with_labels(spark, con):
    rows = {r["doc_id"]: r["accepted"] for r in run(spark, 2).collect()}
    labels = dict(con.execute("SELECT doc_id, quality FROM labels").fetchall())
    assert len(rows) == con.execute("SELECT count(*) FROM documents").fetchone()[0]
    good = [rows[i] for i, q in labels.items() if q == 1]
    assert all(good) and sum(rows[i] != (q == 1) for i, q in labels.items()) <= 0.02 * len(labels)


def test_language_scores(spark, con):
    docs = con.execute("SELECT doc_id, text FROM documents").fetchall()
    rows = {r["doc_id"]: r for r in run(spark, 3).collect()}
    for i, held, n, known, total, base in base_scores(docs):
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held, n, known, total)
        assert abs(r["base_score"] - base) < 1e-6 * abs(base)
    held = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)


def test_byte_tokens(spark, con):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = {r["doc_id"]: r for r in run(spark, 6).collect()}
    for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        ids = library.encode(t, add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert tuple(rows[i])[1:] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_word_ids(spark, con):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows, at = {r["doc_id"]: r for r in run(spark, 7).collect()}, 0
    for i, t in con.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall():
        ids = library.encode(t, add_special_tokens=False).ids + [1]
        assert tuple(rows[i])[1:] == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_url_rules(spark, con):
    rows = {r["page_id"]: r for r in run(spark, 8).collect()}
    for i, url in con.execute("SELECT page_id, url FROM pages").fetchall():
        host, path = split_url(url)
        fits = [r for r in RULES if ("." + host).endswith("." + r.partition("/")[0]) and path.startswith(r[r.index("/") :])]
        rule = max(fits, key=len, default=None)
        assert (rows[i]["host"], rows[i]["path"], rows[i]["rule"]) == (host, path, rule)
        assert rows[i]["verdict"] == RULES[rule] if rule else rows[i]["verdict"] in ("allow", "block")


def test_licenses(spark, con):
    rows = {r["doc_id"]: r["licenses"] for r in run(spark, 10).collect()}
    for i, t in con.execute("SELECT doc_id, text FROM documents").fetchall():
        assert rows[i] == ",".join(licenses(t))
