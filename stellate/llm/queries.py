"""Registered queries of the operators, each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stellate.llm import bpe, decontam, exact, html_text, infill, lbl, licenses, merkle, near, neighbours, quality, ranked, urls
from stellate.llm.common import read


def op1_tag_path_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_pages(read(spark, sf_dir, "pages"))


def op2_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_sites(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")).drop("print")


def op3_log_bilinear(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lbl.language_scores(read(spark, sf_dir, "documents"))


def op4_prefix_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return decontam.leak_digests(found)


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_digests(bpe.encode_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")))


def op7_ranked_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked.round_trip(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(read(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op9_minhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_groups(read(spark, sf_dir, "documents")).drop("print")


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_digests(licenses.scan_licenses(read(spark, sf_dir, "documents")))


def op11_block_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.infill_digests(infill.fill_in_middle(read(spark, sf_dir, "documents")))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_tag_path_text,
        op2_site_quality,
        op3_log_bilinear,
        op4_prefix_decontamination,
        op5_exact_dedup,
        op6_bpe_codec,
        op7_ranked_ids,
        op8_url_filter,
        op9_minhash_groups,
        op10_license_scan,
        op11_block_neighbours,
        op12_fill_in_middle,
        op13_merkle_manifest,
    )
}

_LOWER_AZ = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Levels that the manifest's SQL holds: 16 ** 5 rows a source, 16 ** 3 sources.
SOURCE_LEVELS, ROOT_LEVELS = 5, 3


def _levels(name: str, tree: str, nodes: str, levels: int) -> str:
    """The nodes of ``levels`` levels over ``nodes (tree, pos, n, d)`` and their runs."""
    out = [f"{name}0 AS ({nodes})"]
    for i in range(levels):
        out.append(f"{name}r{i} AS (SELECT {tree}, pos // 16 AS run, list(d ORDER BY pos) AS ds FROM {name}{i} WHERE n > 1 GROUP BY ALL)")
        out.append(
            f"""{name}{i + 1} AS (SELECT {tree}, run AS pos, n, sha256(array_to_string(ds, '')) AS d
                FROM {name}r{i} JOIN (SELECT {tree}, (max(n) + 15) // 16 AS n FROM {name}{i} GROUP BY ALL) USING ({tree})
                UNION ALL SELECT {tree}, pos, n, d FROM {name}{i} WHERE n = 1)"""
        )
    return ",\n        ".join(out)


def _paths(name: str, tree: str, first: str, levels: int) -> str:
    """``first (tree, pos, folded, proof, …)`` with the steps of all levels taken."""
    out = [f"{name}p0 AS ({first})"]
    for i in range(levels):
        left, right = "array_to_string(ds[1 : slot], '')", "array_to_string(ds[slot + 2 :], '')"
        out.append(
            f"""{name}p{i + 1} AS (
                SELECT * EXCLUDE (ds, run, slot) REPLACE (
                    CASE WHEN ds IS NULL THEN pos ELSE run END AS pos,
                    CASE WHEN ds IS NULL THEN proof ELSE proof || {left} || {right} END AS proof,
                    CASE WHEN ds IS NULL THEN folded ELSE sha256({left} || folded || {right}) END AS folded)
                FROM (SELECT p.*, r.ds, p.pos // 16 AS run, p.pos % 16 AS slot
                      FROM {name}p{i} p LEFT JOIN {name}r{i} r ON r.{tree} IS NOT DISTINCT FROM p.{tree} AND r.run = p.pos // 16))"""
        )
    return ",\n        ".join(out)


def _field(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: CRC-32 by its table of 256 remainders (fixed value: the reversed polynomial 3988292384).
_CRC = """crc AS (
            SELECT list(v ORDER BY i) AS tab
            FROM (SELECT i, list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
                  FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS i)))"""
_CRC_OF_ID = """xor(4294967295, list_reduce(
                list_prepend(4294967295, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
                lambda c, b: xor(tab[xor(c, b) % 256 + 1], c >> 8)))"""
_HASHED = """SELECT *, ('0x' || h[1:8])::BIGINT AS h1, ('0x' || h[9:16])::BIGINT AS h2, ('0x' || h[17:24])::BIGINT AS h3, ('0x' || h[25:32])::BIGINT AS h4
             FROM (SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                          regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u FROM documents)"""

ORACLE: dict[str, str] = {
    "op11_block_neighbours": """
        WITH v AS (
            SELECT DISTINCT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        pairs AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   sqrt(list_reduce(list_transform(list_zip(q.e, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 100 = 0)
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM pairs QUALIFY rank <= 10
    """,
    "op12_fill_in_middle": f"""
        WITH h AS ({_HASHED}),
        cut AS (
            SELECT *, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain'
                        WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
        parts AS (
            SELECT *, array_to_string(u[1 : a], '') AS p, array_to_string(u[a + 1 : b], '') AS m, array_to_string(u[b + 1 :], '') AS s FROM cut)
        SELECT doc_id, len(u) AS n, form,
               CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM parts
    """,
    "op13_merkle_manifest": f"""
        WITH {_CRC},
        leaves AS (
            SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf(_LOWER)} AS changed, {_CRC_OF_ID} % 5 = 0 AS hit FROM documents, crc),
        numbered AS (
            SELECT *, row_number() OVER w - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
            FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)),
        {_levels("s", "tree", "SELECT coalesce('1' || source, '0') AS tree, pos, n, leaf AS d FROM numbered", SOURCE_LEVELS)},
        {_levels("t", "tree", f"SELECT 0 AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n, d, tree AS of FROM s{SOURCE_LEVELS}", ROOT_LEVELS)},
        {_paths("s", "tree", "SELECT doc_id, coalesce('1' || source, '0') AS tree, leaf, pos, CASE WHEN hit THEN changed ELSE leaf END AS folded, '' AS proof FROM numbered", SOURCE_LEVELS)},
        {_paths("t", "tree", f"SELECT p.doc_id, p.leaf, t0.d AS subroot, 0 AS tree, t0.pos, p.folded, p.proof FROM sp{SOURCE_LEVELS} p JOIN t0 ON t0.of = p.tree", ROOT_LEVELS)}
        SELECT doc_id, leaf, subroot, d AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = d AS verified
        FROM tp{ROOT_LEVELS}, (SELECT d FROM t{ROOT_LEVELS})
    """,
    "op4_prefix_decontamination": f"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
        b AS (
            SELECT item_id, regexp_extract_all({_LOWER_AZ}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
        win AS (
            SELECT DISTINCT item_id, least(len(ws), 10) AS l, array_to_string(ws[i : i + least(len(ws), 10) - 1], ' ') AS t
            FROM (SELECT item_id, ws, unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS i FROM b WHERE len(ws) > 0)),
        spots AS (
            SELECT doc_id, l, i, array_to_string(ws[i : i + l - 1], ' ') AS t
            FROM (SELECT doc_id, ws, l, unnest(generate_series(1, len(ws) - l + 1)) AS i
                  FROM d CROSS JOIN (SELECT DISTINCT l FROM win) WHERE len(ws) >= l)),
        hit AS (SELECT doc_id, item_id, i, l FROM spots JOIN win USING (l, t)),
        words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(generate_series(i, i + l - 1)) AS p FROM hit) GROUP BY doc_id),
        ids AS (SELECT doc_id, count(*) AS n, string_agg(s, ',' ORDER BY s) AS joined
                FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
        SELECT d.doc_id, len(ws) AS n_words, coalesce(words.n, 0) AS n_hit, coalesce(ids.n, 0) AS n_items,
               sha256(coalesce(joined, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
        FROM d LEFT JOIN words USING (doc_id) LEFT JOIN ids USING (doc_id)
    """,
    "op9_minhash_groups": f"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all({_LOWER_AZ}, '[^\\x20\\x09-\\x0D]+') AS ws
            FROM documents),
        s AS (
            SELECT DISTINCT doc_id, array_to_string(ws[i : i + 4], ' ') AS sh
            FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(len(ws) - 4, least(len(ws), 1)))) AS i FROM w)),
        n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
        links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id
            JOIN n na ON na.doc_id = a.doc_id JOIN n nb ON nb.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, na.n, nb.n
            HAVING 100 * count(*) >= 75 * (na.n + nb.n - count(*))),
        reach AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION
            SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
        c AS (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a)
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, d.doc_id = c.component_id AS kept
        FROM documents d JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
    "op5_exact_dedup": """
        WITH d AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g')) AS h
            FROM documents)
        SELECT doc_id,
               first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY h) AS group_size,
               first_value(doc_id) OVER w = doc_id AS kept,
               h AS text_sha256
        FROM d WINDOW w AS (PARTITION BY h ORDER BY n DESC, doc_id)
    """,
}
