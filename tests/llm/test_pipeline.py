import hashlib
import re
import tempfile

import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from stellate.llm.quality import score_sites
from tests.llm.helpers import corpus, prose
from tests.llm.test_decontam import ITEMS, brute as leaks
from tests.llm.test_near import brute as near

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def write_tables(spark, docs, labels):
    folder = tempfile.mkdtemp(prefix="stellate-pipe-")
    rows = [(i, t, "en" if (i or 0) % 2 else "fr", f"src{(i or 0) % 3}", len(t or "")) for i, t in docs]
    spark.createDataFrame(rows, DOCS).withColumn("kept", F.lit("x")).repartition(4).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def small_corpus():
    good = [(i, t) for i, t in corpus() if not t or len(t) < 5000]
    item = prose(3, 40).split()
    junk = [(900 + i, "BUY!! " * (20 + i)) for i in range(30)]
    return good + junk + [(950, "before " + " ".join(item[4:18]) + " after"), (951, prose(951, 60))]


def test_run_matches_brute_force(spark):
    docs = small_corpus()
    labels = [(i, 1, 0) for i, t in docs if i < 60] + [(i, 0, 0) for i, _ in docs if 900 <= i < 920]
    folder = write_tables(spark, docs, labels)
    table = spark.read.parquet(f"{folder}/documents.parquet")
    accepted = {(r["doc_id"], r["text"]) for r in table.join(score_sites(table, spark.read.parquet(f"{folder}/labels.parquet")).where("accepted").select("doc_id"), "doc_id").collect()}
    assert not any(i >= 900 and i < 930 for i, _ in accepted) and (951, prose(951, 60)) in accepted

    exact = {}
    for i, t in accepted:
        key = re.sub(r"[\x20\x09-\x0D]+", "", t or "")
        exact.setdefault(key, []).append((-len(t or ""), i, t))
    stays = [min(g)[1:] for g in exact.values()]
    keep = {i for i, _, _, kept in near(stays) if kept}
    stays = [(i, t) for i, t in stays if i in keep]
    clean = {r[0] for r in leaks(stays, ITEMS) if not r[5]}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    expect = sorted((i, len(ids := library.encode(t or "").ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256((t or "").encode()).hexdigest()) for i, t in stays if i in clean)
    assert sorted(map(tuple, corpus_pipeline.run(spark, folder).collect())) == expect
    assert 950 not in {r[0] for r in expect}


def test_stages_keep_the_columns(spark):
    folder = write_tables(spark, small_corpus()[:40], [(1, 1, 0)])
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, folder).columns == docs.columns


def test_empty_documents(spark):
    assert corpus_pipeline.run(spark, write_tables(spark, [], [])).count() == 0


def test_stage_names():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "decontamination", "tokens"]
    assert corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("n", range(1, 11))
def test_every_operator_is_registered(n):
    import __spark_entry__

    assert len([q for q in __spark_entry__.queries() if q.startswith(f"op{n}_")]) == 1
    assert "pipeline" in __spark_entry__.queries()
