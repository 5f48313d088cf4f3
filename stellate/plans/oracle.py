"""DuckDB SQL equal to each registered query in ``stellate.plans.queries``.

The SQL is generated from the same fixed values and mappings as the Spark side (the
views in ``stellate.plans.views``), written the way a database user would write it:
CTEs, ``ROW_NUMBER``, ``NOT EXISTS``, ``FULL OUTER JOIN`` + ``COALESCE``.
"""

from __future__ import annotations

from stellate.operators.mapping import TableMap
from stellate.plans import queries as Q
from stellate.plans import views as V

SCORED = [m for m in V.W_MEASURES]


def _conv(src: str, kind: str) -> str:
    v = f"NULLIF({src}, '')"
    return {
        "text": v,
        "double": f"CAST({v} AS DOUBLE)",
        "bigint": f"CAST({v} AS BIGINT)",
        "bigint_round": f"CAST(round_even(CAST({v} AS DOUBLE), 0) AS BIGINT)",
        "date": f"CAST({v} AS DATE)",
    }[kind]


def _project(tmap: TableMap, rel: str) -> str:
    cols = ", ".join(f"{_conv(c.source, c.kind)} AS {c.target}" for c in tmap.all_columns)
    return f"SELECT {cols} FROM {rel}"


def _upsert(t: str, s: str, keys: list[str], cols: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    out = ", ".join([f"COALESCE(t.{k}, s.{k}) AS {k}" for k in keys] + [f"COALESCE(s.{c}, t.{c}) AS {c}" for c in cols])
    return f"SELECT {out} FROM {t} t FULL OUTER JOIN {s} s ON {on}"


def _update(t: str, s: str, keys: list[str], cols: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    out = ", ".join([f"t.{k} AS {k}" for k in keys] + [f"COALESCE(s.{c}, t.{c}) AS {c}" for c in cols])
    return f"SELECT {out} FROM {t} t LEFT JOIN {s} s ON {on}"


def _insert(t: str, s: str, keys: list[str], cols: list[str]) -> str:
    on = " AND ".join(f"x.{k} = s.{k}" for k in keys)
    allc = ", ".join(keys + cols)
    return (
        f"SELECT {allc} FROM {t} UNION ALL SELECT {allc} FROM {s} s "
        f"WHERE NOT EXISTS (SELECT 1 FROM {t} x WHERE {on})"
    )


W_SQL = (
    "SELECT CAST(user_id AS VARCHAR) AS entity, CAST(CAST(ts AS DATE) AS VARCHAR) AS day, "
    "'user-' || CAST(user_id AS VARCHAR) AS label, "
    + ", ".join(f"CASE WHEN event_type = '{t}' THEN CAST(value AS VARCHAR) ELSE '' END AS m_{t}" for t in V.EVENT_TYPES)
    + ", CASE WHEN value >= 10 THEN CAST(value AS VARCHAR) ELSE '' END AS m_large"
    + ", CASE WHEN hour(ts) < 12 THEN CAST(event_id AS VARCHAR) ELSE '' END AS m_early"
    + ", event_id FROM events"
)


def _present(columns: list[str]) -> str:
    """How many of the cells hold something."""
    return "CAST(list_aggregate([" + ", ".join(f"NULLIF({c}, '')" for c in columns) + "], 'count') AS INTEGER)"


SCORE_SQL = _present(SCORED)


def _dedup(rel: str) -> str:
    """Of each key the row with most cells, then the earliest event."""
    return f"SELECT DISTINCT ON (entity, day) *, {SCORE_SQL} AS score FROM {rel} ORDER BY entity, day, score DESC, event_id"


def _last_report(rel: str) -> str:
    return (
        f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY entity, day "
        f"ORDER BY event_id DESC) AS rn FROM {rel}) WHERE rn = 1"
    )


def _latest(rel: str) -> str:
    return (
        f"SELECT d.* FROM {rel} d JOIN (SELECT entity, MAX(CAST(day AS DATE)) AS md FROM {rel} "
        f"WHERE entity IS NOT NULL AND day IS NOT NULL GROUP BY entity) m "
        f"ON d.entity = m.entity AND CAST(d.day AS DATE) = m.md"
    )


BASE = (
    f"WITH w AS ({W_SQL}), "
    f"wd AS ({_dedup('w')}), "
    f"wt AS (SELECT * EXCLUDE (score) FROM ({_dedup(f'(SELECT * FROM w WHERE day < {V.W_TARGET_BEFORE!r})')})), "
    f"ws AS ({_last_report(f'(SELECT * FROM w WHERE day >= {V.W_SOURCE_FROM!r})')}) "
)

ORDER_COLS = ["o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDERS = (
    "WITH ot AS (SELECT o_orderkey, o_custkey, o_orderstatus, "
    "CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority "
    f"FROM orders WHERE o_orderdate < TIMESTAMP '{V.ORDERS_TARGET_BEFORE}'), "
    "os AS (SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority <> '1-URGENT' THEN o_orderstatus END "
    "AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate, o_orderpriority "
    f"FROM orders WHERE o_orderdate >= TIMESTAMP '{V.ORDERS_SOURCE_FROM}') "
)
UPSERT_ORDERS = ORDERS + _upsert("ot", "os", ["o_orderkey"], ORDER_COLS)


def _fact_halves(n: int) -> str:
    f = V.W_FACTS[n]
    return BASE + f", ft AS ({_project(f, 'wt')}), fs AS ({_project(f, 'ws')}) "


def _fact_upsert(n: int) -> str:
    f = V.W_FACTS[n]
    return _fact_halves(n) + _upsert("ft", "fs", f.key_names, f.value_names)


def _counts(flagged: str) -> str:
    return (
        "SELECT COUNT(CASE WHEN in_s AND NOT in_t THEN 1 END) AS inserted, "
        "COUNT(CASE WHEN in_s AND in_t THEN 1 END) AS matched_before, "
        "COUNT(CASE WHEN in_t AND NOT in_s THEN 1 END) AS target_only, "
        "COUNT(*) AS total_after, 0 AS rejected_null_keys, "
        "COUNT(CASE WHEN in_s AND NOT in_t THEN 1 END) + COUNT(CASE WHEN in_s AND in_t THEN 1 END) AS updated "
        f"FROM {flagged}"
    )


def _flags(t: str, s: str, keys: list[str]) -> str:
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    return (
        f"(SELECT t.{keys[0]} IS NOT NULL AS in_t, s.{keys[0]} IS NOT NULL AS in_s "
        f"FROM (SELECT *, 1 AS one FROM {t}) t FULL OUTER JOIN (SELECT *, 1 AS one FROM {s}) s ON {on})"
    )


def _load_summary() -> str:
    d = V.W_DIMENSION
    parts = [
        f"dt AS ({_project(d, '(' + _latest('wt') + ')')})",
        f"ds AS ({_project(d, '(' + _latest('ws') + ')')})",
    ]
    for i, f in enumerate(V.W_FACTS):
        parts.append(f"f{i}t AS ({_project(f, 'wt')})")
        parts.append(f"f{i}s AS ({_project(f, 'ws')})")
    sql = BASE + ", " + ", ".join(parts) + " "
    pieces = [
        f"SELECT '{d.name}' AS tbl, inserted, updated, total_after FROM ({_counts(_flags('dt', 'ds', d.key_names))})"
    ]
    for i, f in enumerate(V.W_FACTS):
        pieces.append(
            f"SELECT '{f.name}' AS tbl, inserted, updated, total_after "
            f"FROM ({_counts(_flags(f'f{i}t', f'f{i}s', f.key_names))})"
        )
    return sql + " UNION ALL ".join(pieces)


def _table_counts() -> str:
    d = V.W_DIMENSION
    pieces = [f"SELECT '{d.name}' AS tbl, COUNT(*) AS n_rows FROM ({_project(d, '(' + _latest('wd') + ')')})"]
    pieces += [f"SELECT '{f.name}' AS tbl, COUNT(*) AS n_rows FROM ({_project(f, 'wd')})" for f in V.W_FACTS]
    return BASE + " UNION ALL ".join(pieces)


def _stream_upsert() -> str:
    f = V.W_FACTS[0]
    return BASE + f", ft AS ({_project(f, 'wt')}), fs AS ({_project(f, 'wd')}) " + _upsert(
        "ft", "fs", f.key_names, f.value_names
    )


def _row_digest(fact: TableMap) -> str:
    cells = [f"CAST(round({c.target} * 100) AS BIGINT)" if c.kind == "double" else c.target for c in fact.all_columns]
    joined = " || '|' || ".join(f"coalesce(CAST({c} AS VARCHAR), '~')" for c in cells)
    return f"('0x' || md5({joined})[1:8])::BIGINT"


def _w_facts() -> str:
    parts = []
    for m in V.W_FACTS:
        values = [*m.value_names, "NULL", "NULL", "NULL"][:3]
        cells = ", ".join(f"CAST({v} AS DOUBLE) AS v{i}" for i, v in enumerate(values, 1))
        parts.append(f"SELECT '{m.name}' AS tbl, {', '.join(m.key_names)}, {cells} FROM ({_project(m, 'wd')})")
    return BASE + " UNION ALL ".join(parts)


def _w_counts(tail: str) -> str:
    """Counts of a load of ``W`` into empty targets."""
    users = f"SELECT '{V.W_DIMENSION.name}' AS tbl, COUNT(DISTINCT entity) AS n FROM wd"
    facts = [f"SELECT '{m.name}' AS tbl, COUNT(*) AS n FROM wd" for m in V.W_FACTS]
    return BASE + f"SELECT tbl, {tail} FROM (" + " UNION ALL ".join([users, *facts]) + ")"


def _cast_errors() -> str:
    """Bad cells of the deduplicated rows, by target column; the bad text changes no score."""
    parts = []
    for m in (V.W_DIMENSION, *V.W_FACTS):
        for c in m.all_columns:
            if c.kind != "text":
                bad = {"m_large": "m_large <> ''", "m_click": "m_click <> ''"}.get(c.source, "FALSE")
                parts.append(f"SELECT '{m.name}.{c.target}' AS target_column, COUNT(*) FILTER ({bad}) AS cells FROM wd")
    return BASE + " UNION ALL ".join(parts)


def _health_sql() -> dict[str, str]:
    """The health queries: wide view, dedup, dimension, facts — from the same mappings."""
    from stellate.plans import health as H

    def money(c: str) -> str:
        cents = f"CAST(round({c} * 100.0) AS BIGINT)"
        return f"CAST({cents} // 100 AS VARCHAR) || '.' || lpad(CAST({cents} % 100 AS VARCHAR), 2, '0')"

    base = {
        "label": "'Supplier ' || CAST(l_suppkey AS VARCHAR)",
        "text": "l_returnflag || '-' || l_linestatus",
        "bigint": "CAST(CAST(l_quantity AS BIGINT) AS VARCHAR)",
        "bigint_round": "CAST(l_quantity + 0.5 AS VARCHAR)",
        "price": money("l_extendedprice"),
        "tax": money("l_tax"),
    }
    cells = []
    for _, name, value, threshold in V.health_cells():
        cond = "TRUE" if threshold is None else f"l_discount >= CAST({threshold!r} AS DOUBLE)"
        cells.append(f"CASE WHEN {cond} THEN {base[value]} ELSE '' END AS {name}")
    wide = (
        f"SELECT 'S' || CAST(l_suppkey AS VARCHAR) AS {H.ENTITY}, "
        f"CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS {H.DATE}, " + ", ".join(cells)
    )
    scored = [n for _, n, _, _ in V.health_cells() if n != H.LABEL]
    order = ", ".join(f"{c} ASC NULLS LAST" for c in scored)

    def dedup(rel: str) -> str:
        return (
            f"SELECT DISTINCT ON ({H.ENTITY}, {H.DATE}) *, {_present(scored)} AS score FROM {rel} "
            f"WHERE NULLIF({H.ENTITY}, '') IS NOT NULL AND {H.DATE} IS NOT NULL ORDER BY {H.ENTITY}, {H.DATE}, score DESC, {order}"
        )

    def latest(rel: str) -> str:
        return f"SELECT DISTINCT ON ({H.ENTITY}) * FROM {rel} ORDER BY {H.ENTITY}, CAST({H.DATE} AS DATE) DESC"

    base = f"WITH hw AS ({wide} FROM lineitem), hd AS ({dedup('hw')}) "
    first = f"CAST(l_shipdate AS DATE) < DATE '{V.HEALTH_FIRST_BEFORE}'"
    second = f"CAST(l_shipdate AS DATE) >= DATE '{V.HEALTH_SECOND_FROM}'"
    blanked = f"(SELECT * REPLACE (CASE WHEN l_discount >= CAST({V.HEALTH_SECOND_DISCOUNT!r} AS DOUBLE) THEN l_discount ELSE -1.0::DOUBLE END AS l_discount) FROM lineitem WHERE {second})"
    twice = (
        f"WITH w1 AS ({wide} FROM lineitem WHERE {first}), w2 AS ({wide} FROM {blanked}), "
        f"d1 AS ({dedup('w1')}), d2 AS ({dedup('w2')}), "
    )
    out = {
        "health_dedup": base + "SELECT * FROM hd",
        "health_locatii": base + _project(H.LOCATII, f"({latest('hd')})"),
    }
    for f in H.FACTS:
        out[f"health_{f.name}"] = base + _project(f, "hd")
    # Into empty targets every key is inserted, and "updated" counts them again.
    parts = [
        f"SELECT '{H.LOCATII.name}' AS tbl, COUNT(DISTINCT {H.ENTITY}) AS inserted, "
        f"COUNT(DISTINCT {H.ENTITY}) AS updated, COUNT(DISTINCT {H.ENTITY}) AS total_after FROM hd"
    ]
    parts += [
        f"SELECT '{f.name}' AS tbl, COUNT(*) AS inserted, COUNT(*) AS updated, COUNT(*) AS total_after FROM hd"
        for f in H.FACTS
    ]
    for f in (H.LOCATII, *H.FACTS):
        of = (lambda d: f"({latest(d)})") if f is H.LOCATII else str
        sides = f"t AS ({_project(f, of('d1'))}), s AS ({_project(f, of('d2'))}) "
        out[f"health_upsert_{f.name}"] = twice + sides + _upsert("t", "s", f.key_names, f.value_names)
    f = H.FACTS[0]
    narrow = f"t AS ({_project(f, 'd1')}), s AS (SELECT * REPLACE ({', '.join(f'NULL AS {c}' for c in f.value_names[-2:])}) FROM ({_project(f, 'd2')})) "
    out["narrow_source_merge"] = twice + narrow + _upsert("t", "s", f.key_names, f.value_names)
    out["batched_load"] = base + " UNION ALL ".join(
        f"SELECT '{f.name}' AS tbl, COUNT(*) AS inserted, COUNT(*) AS updated, CAST(SUM({_row_digest(f)}) AS BIGINT) AS rows_digest FROM ({_project(f, 'hd')})"
        for f in H.FACTS
    )
    out["health_load"] = base + " UNION ALL ".join(parts)
    return out


_STAGE = (
    "CASE event_type WHEN 'click' THEN 'copy' WHEN 'view' THEN 'dedup' WHEN 'purchase' THEN 'create_staging' "
    "WHEN 'signup' THEN 'commit' ELSE 'drop_staging' END"
)

ORACLE: dict[str, str] = {
    "stage_text": W_SQL,
    "typed_projection": f"WITH w AS ({W_SQL}) {_project(V.W_TYPED, 'w')}",
    "rint_bigint": (
        "SELECT p_partkey, p_size / 2.0::DOUBLE AS half, "
        "CAST(round_even(CAST(CAST(p_size / 2.0::DOUBLE AS VARCHAR) AS DOUBLE), 0) AS BIGINT) AS half_rounded FROM part"
    ),
    "completeness_score": f"WITH w AS ({W_SQL}) SELECT entity, day, event_id, {SCORE_SQL} AS score FROM w",
    "dedup_most_complete": BASE + "SELECT * FROM wd",
    "dedup_any_per_key": "SELECT DISTINCT l_orderkey, l_linenumber, TRUE AS row_exists FROM lineitem",
    "latest_per_entity": BASE + _latest("wd"),
    "split_dimension": BASE + _project(V.W_DIMENSION, "(" + _latest("wd") + ")"),
    "split_fact_1": BASE + _project(V.W_FACTS[0], "wd"),
    "split_fact_2": BASE + _project(V.W_FACTS[1], "wd"),
    "split_fact_3": BASE + _project(V.W_FACTS[2], "wd"),
    "insert_absent": ORDERS + _insert("ot", "os", ["o_orderkey"], ORDER_COLS),
    "insert_absent_composite": _fact_halves(2)
    + _insert("ft", "fs", V.W_FACTS[2].key_names, V.W_FACTS[2].value_names),
    "update_coalesce": ORDERS + _update("ot", "os", ["o_orderkey"], ORDER_COLS),
    "update_coalesce_composite": _fact_halves(2)
    + _update("ft", "fs", V.W_FACTS[2].key_names, V.W_FACTS[2].value_names),
    "upsert_orders": UPSERT_ORDERS,
    "upsert_orders_auto": UPSERT_ORDERS,
    "runtime_filtered_upsert": UPSERT_ORDERS,
    "upsert_fact_1": _fact_upsert(0),
    "upsert_fact_2": _fact_upsert(1),
    "upsert_fact_3": _fact_upsert(2),
    "upsert_dimension": BASE
    + f", dt AS ({_project(V.W_DIMENSION, '(' + _latest('wt') + ')')}), "
    + f"ds AS ({_project(V.W_DIMENSION, '(' + _latest('ws') + ')')}) "
    + _upsert("dt", "ds", V.W_DIMENSION.key_names, V.W_DIMENSION.value_names),
    "merge_counts": ORDERS + _counts(_flags("ot", "os", ["o_orderkey"])),
    "upsert_idempotent": UPSERT_ORDERS,
    "key_ordinal": "SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn FROM orders",
    "key_batches": (
        "SELECT o_orderkey, rn, CAST(FLOOR((rn - 1) / " + str(Q.BATCH_SIZE) + ") + 1 AS BIGINT) AS batch "
        "FROM (SELECT o_orderkey, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn FROM orders)"
    ),
    "batched_upsert": UPSERT_ORDERS,
    "key_slice": (
        ORDERS + ", n AS (SELECT *, ROW_NUMBER() OVER (ORDER BY o_orderkey) AS rn, COUNT(*) OVER () AS total FROM os) "
        f"SELECT o_orderkey, {', '.join(ORDER_COLS)} FROM n "
        f"WHERE rn BETWEEN CEIL(total / {Q.UPSERT_BATCHES}.0) + 1 AND 2 * CEIL(total / {Q.UPSERT_BATCHES}.0)"
    ),
    "batch_totals": (
        "SELECT o_orderpriority AS tbl, COUNT(*) FILTER (o_orderstatus <> 'F') AS inserted, COUNT(*) AS updated, "
        "COUNT(*) / 1024.0::DOUBLE AS sec FROM orders GROUP BY 1"
    ),
    "staging_total": "SELECT COUNT(*) / 1024.0::DOUBLE AS staging_total_sec FROM events",
    "upserts_total": "SELECT COUNT(*) / 1024.0::DOUBLE AS upserts_sec FROM orders",
    "stage_ranking": f"SELECT {_STAGE} AS stage, COUNT(*) / 1024.0::DOUBLE AS sec FROM events GROUP BY 1",
    "phase_shares": (
        f"WITH p AS (SELECT {_STAGE} AS phase, COUNT(*) / 1024.0::DOUBLE AS sec FROM events GROUP BY 1 "
        "UNION ALL SELECT 'upserts', COUNT(*) / 1024.0::DOUBLE FROM orders), "
        "q AS (SELECT * FROM p WHERE phase IN ('copy', 'dedup', 'upserts', 'commit')) "
        "SELECT phase, sec, sec / (SELECT SUM(sec) FROM q) AS share FROM q"
    ),
    "throughput": (
        "WITH t AS (SELECT COUNT(*)::DOUBLE AS n, SUM(strlen(props))::DOUBLE AS b, "
        "(COUNT(*) FILTER (event_type = 'click')) / 1024.0::DOUBLE AS s FROM events) "
        "SELECT n AS processed, n + 1 AS total_lines, s AS duration_sec, n / s AS rows_per_sec, "
        "b / 1000000.0::DOUBLE / s AS mb_per_sec, b / 1000000.0::DOUBLE AS size_mb FROM t"
    ),
    "orphan_check": "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    "duplicate_keys": (
        "SELECT l_orderkey, l_linenumber, COUNT(*) AS n FROM lineitem "
        "GROUP BY l_orderkey, l_linenumber HAVING COUNT(*) > 1"
    ),
    "null_violations": (
        f"WITH w0 AS ({W_SQL}), w AS (SELECT * REPLACE (CASE WHEN m_error <> '' THEN '' ELSE label END AS label) "
        f"FROM w0), t AS ({_project(V.W_TYPED, 'w')}) "
        "SELECT * FROM t WHERE user_key IS NULL OR day IS NULL OR user_label IS NULL"
    ),
    "table_counts": _table_counts(),
    "retention": (
        f"WITH w AS ({W_SQL}) SELECT staged_rows, dedup_rows, "
        "COALESCE(100.0 * dedup_rows / NULLIF(staged_rows, 0), 0.0) AS retention_pct FROM "
        "(SELECT COUNT(*) AS staged_rows, (SELECT COUNT(*) FROM (SELECT DISTINCT entity, day FROM w)) AS dedup_rows FROM w)"
    ),
    "load_summary": _load_summary(),
    "stream_upsert": _stream_upsert(),
    "csv_stage": f"WITH w AS ({W_SQL}) SELECT entity, day, label, "
    + ", ".join(f"NULLIF({m}, '') AS {m}" for m in V.W_MEASURES)
    + ", CAST(event_id AS VARCHAR) AS event_id FROM w",
}
ORACLE["csv_many_files"] = ORACLE["csv_stage"]
W_COLUMNS = ["entity", "day", "label", *V.W_MEASURES, "event_id"]
_LINE = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in W_COLUMNS)
_SHORT = " || ',' || ".join(f"CAST({c} AS VARCHAR)" for c in W_COLUMNS[:-1])
ORACLE |= {
    "range_batched_load": _w_facts(),
    "replayed_load": _w_counts("n AS inserted, n AS updated, n AS total_after"),
    "concurrent_read_merge": f"SELECT kind, moment, u.* FROM ({UPSERT_ORDERS}) u, (VALUES ('months'), ('whole')) k(kind), (VALUES ('during'), ('after')) m(moment)",
    "footer_counts": BASE + " UNION ALL ".join(f"SELECT '{m.name}' AS tbl, day[1:7] AS month, COUNT(*) AS n_rows FROM wd GROUP BY ALL" for m in V.W_FACTS),
    "bucketed_load": UPSERT_ORDERS,
    "csv_headers": f"SELECT DISTINCT label, '{','.join(W_COLUMNS)}' AS line FROM ({W_SQL})",
    "csv_rejects": (
        f"SELECT CASE WHEN m_error = '' THEN 'good' ELSE 'reject' END AS kind, "
        f"CASE WHEN m_error = '' THEN {_LINE} WHEN m_early <> '' THEN {_LINE} || ',more' ELSE {_SHORT} END AS raw FROM ({W_SQL})"
    ),
    "cast_errors": _cast_errors(),
    "stream_metrics": "SELECT COUNT(*) AS n_rows, 0::BIGINT AS first_batch FROM events",
}
ORACLE.update(_health_sql())
