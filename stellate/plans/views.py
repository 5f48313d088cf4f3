"""Views derived from the shared test tables that stand in for the wide daily file.

``wide_view`` turns ``events`` into a sparse all-text table keyed by (entity, day), the
shape of the real input: several rows per key, cells empty where the event did not
report a measure. The target/source halves model an incremental load: a target loaded
with history up to a cut-off, and a newer extract that overlaps it, so keys occur only in
the target, only in the source, or in both — and where both hold the key, the source
row is a different report of the same key with its own empty cells.

Every view here reads whole tables; the halves are split by time, as loads are.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stellate.operators import dedup, mapping
from stellate.operators.mapping import table

# Fixed values of the derived test schema.
EVENT_TYPES = ("click", "view", "purchase", "signup", "error")
W_KEYS = ("entity", "day")
W_LABEL = "label"
W_TIEBREAK = "event_id"
W_MEASURES = ("m_click", "m_view", "m_purchase", "m_signup", "m_error", "m_large", "m_early")
# History is loaded up to (not including) TARGET_BEFORE; the new extract starts at SOURCE_FROM.
W_TARGET_BEFORE = "2024-01-21"
W_SOURCE_FROM = "2024-01-11"
ORDERS_TARGET_BEFORE = "1998-01-01"
ORDERS_SOURCE_FROM = "1997-01-01"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def wide_view(events: DataFrame) -> DataFrame:
    """All-text wide view ``W`` of ``events``; a missing cell is ``''``."""
    value = F.col("value").cast("string")
    return events.select(
        F.col("user_id").cast("string").alias("entity"),
        F.to_date("ts").cast("string").alias("day"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("label"),
        *[F.when(F.col("event_type") == t, value).otherwise(F.lit("")).alias(f"m_{t}") for t in EVENT_TYPES],
        F.when(F.col("value") >= 10, value).otherwise(F.lit("")).alias("m_large"),
        F.when(F.hour("ts") < 12, F.col("event_id").cast("string")).otherwise(F.lit("")).alias("m_early"),
        F.col("event_id"),
    )


def w(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wide_view(read(spark, sf_dir, "events"))


def w_dedup(wide: DataFrame) -> DataFrame:
    """Most complete row per (entity, day); ties to the smallest event id."""
    return dedup.most_complete(wide, W_KEYS, exclude=[W_LABEL, W_TIEBREAK], tiebreak=[W_TIEBREAK])


def w_last_report(wide: DataFrame) -> DataFrame:
    """Last reported row per (entity, day): the largest event id (a correction extract)."""
    win = Window.partitionBy(*W_KEYS).orderBy(F.col(W_TIEBREAK).desc())
    return wide.withColumn("__r", F.row_number().over(win)).filter("__r = 1").drop("__r")


def w_target_half(wide: DataFrame) -> DataFrame:
    """History: most complete rows of the days before ``W_TARGET_BEFORE``."""
    return w_dedup(wide.filter(F.col("day") < W_TARGET_BEFORE)).drop(dedup.SCORE)


def w_source_half(wide: DataFrame) -> DataFrame:
    """New extract: last reported rows of the days from ``W_SOURCE_FROM``."""
    return w_last_report(wide.filter(F.col("day") >= W_SOURCE_FROM))


# Mappings of W onto a star schema: one dimension and three facts.
W_DIMENSION = table(
    "users",
    keys=[("entity", "user_key", "text")],
    columns=[
        ("label", "user_label", "text", False),
        ("m_large", "large_value", "double"),
        ("m_large", "large_rounded", "bigint_round"),
    ],
)
W_FACTS = (
    table(
        "activity_daily",
        keys=[("entity", "user_key", "text"), ("day", "day", "date")],
        columns=[("m_click", "clicks", "double"), ("m_view", "views", "double")],
    ),
    table(
        "conversion_daily",
        keys=[("entity", "user_key", "text"), ("day", "day", "date")],
        columns=[("m_purchase", "purchases", "double"), ("m_signup", "signups", "double")],
    ),
    table(
        "quality_daily",
        keys=[("entity", "user_key", "text"), ("day", "day", "date")],
        columns=[
            ("m_error", "errors", "double"),
            ("m_large", "large_value", "double"),
            ("m_early", "early_event", "bigint"),
        ],
    ),
)
W_TYPED = table(
    "w_typed",
    keys=[("entity", "user_key", "text"), ("day", "day", "date")],
    columns=[("label", "user_label", "text")]
    + [(m, m[2:], "double") for m in W_MEASURES if m != "m_early"]
    + [("m_early", "early", "bigint"), ("m_large", "large_rounded", "bigint_round")],
)


def latest_rows(deduped: DataFrame) -> DataFrame:
    """Latest deduplicated row per entity, the day compared as a DATE."""
    dated = deduped.withColumn("__date", mapping.convert(F.col("day"), "date"))
    return dedup.latest_per_entity(dated, "entity", "__date").drop("__date")


def dimension(deduped: DataFrame) -> DataFrame:
    return mapping.project(latest_rows(deduped), W_DIMENSION)


def orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders loaded before the cut-off; prices of low-priority orders were never filled."""
    o = read(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") < F.lit(ORDERS_TARGET_BEFORE).cast("timestamp_ntz")).select(
        "o_orderkey",
        "o_custkey",
        "o_orderstatus",
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Newer extract: corrected prices (+1); urgent orders arrive without a status."""
    o = read(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderdate") >= F.lit(ORDERS_SOURCE_FROM).cast("timestamp_ntz")).select(
        "o_orderkey",
        "o_custkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.col("o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + F.lit(1.0)).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )


#: The two extracts of the wide daily file overlap in the half year between these days.
HEALTH_FIRST_BEFORE, HEALTH_SECOND_FROM, HEALTH_SECOND_DISCOUNT = "1996-01-01", "1995-07-01", 0.05


def health_extracts(lineitem: DataFrame) -> tuple[DataFrame, DataFrame]:
    """History, and a newer extract that overlaps it. The newer one reports every line, but
    leaves the cells of little discounted ones empty, so that shared keys bring other cells,
    and fewer, the second time."""
    day = F.to_date("l_shipdate")
    first = lineitem.filter(day < F.lit(HEALTH_FIRST_BEFORE).cast("date"))
    second = lineitem.filter(day >= F.lit(HEALTH_SECOND_FROM).cast("date"))
    blanked = F.when(F.col("l_discount") >= HEALTH_SECOND_DISCOUNT, F.col("l_discount")).otherwise(F.lit(-1.0))
    return health_wide_view(first), health_wide_view(second.withColumn("l_discount", blanked))


def w_schema():
    """The derived wide file ``W`` as a load: one dimension, three facts."""
    from stellate.plans.load import StarSchema

    return StarSchema("entity", "day", W_LABEL, W_DIMENSION, W_FACTS, tiebreak=(W_TIEBREAK,))


def w_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``W`` as a text file has it: the tie-break as padded digits, which order as numbers do."""
    return w(spark, sf_dir).withColumn(W_TIEBREAK, F.lpad(F.col(W_TIEBREAK).cast("string"), 12, "0"))


def bad_cells(wide: DataFrame) -> DataFrame:
    """``W`` with cells that do not convert: large values read ``n/a``, clicks have a unit."""
    unit = F.when(F.col("m_click") != "", F.concat(F.col("m_click"), F.lit(" clicks"))).otherwise(F.col("m_click"))
    return wide.withColumn("m_large", F.when(F.col("m_large") != "", F.lit("n/a")).otherwise(F.col("m_large"))).withColumn("m_click", unit)


def load_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A metrics frame derived from given tables: stage seconds from ``events`` (a 1024th
    of a second for each event of a type, so that sums are exact), upserts from ``orders``."""
    stages = {"click": "copy", "view": "dedup", "purchase": "create_staging", "signup": "commit", "error": "drop_staging"}
    ev, o = read(spark, sf_dir, "events"), read(spark, sf_dir, "orders")
    name = F.create_map(*[F.lit(x) for kv in stages.items() for x in kv])[F.col("event_type")]
    row = lambda section, name, metric, value: (F.lit(section).alias("section"), name.alias("name"), F.lit(metric).alias("metric"), value.cast("double").alias("value"))
    per_type = ev.groupBy(name.alias("name")).agg((F.count(F.lit(1)) / 1024.0).alias("v")).select(*row("stages", F.col("name"), "sec", F.col("v")))
    seconds = F.sum(F.when(F.col("event_type") == "click", 1).otherwise(0)) / 1024.0
    copy = [
        ev.select(*row("copy", F.lit("source"), m, v))
        for m, v in (("rows", F.count(F.lit(1))), ("lines", F.count(F.lit(1)) + 1), ("bytes", F.sum(F.octet_length("props"))), ("sec", seconds))
    ]
    ups = o.groupBy(F.col("o_orderpriority").alias("name")).agg((F.count(F.lit(1)) / 1024.0).alias("v")).select(*row("upserts", F.col("name"), "sec", F.col("v")))
    out = per_type.unionByName(ups)
    for c in copy:
        out = out.unionByName(c)
    return out


#: The five order priorities stand for the five fact tables of a log.
LOG_FACTS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


def batch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch log derived from ``orders``: one batch for each priority and month."""
    o = read(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_orderpriority").alias("table"), F.date_format("o_orderdate", "yyyy-MM").alias("batch")).agg(
        F.count(F.when(F.col("o_orderstatus") != "F", 1)).alias("inserted"),
        F.count(F.lit(1)).alias("updated"),
        (F.count(F.lit(1)) / 1024.0).alias("sec"),
    )


def health_wide_view(lineitem: DataFrame) -> DataFrame:
    """A wide, sparse, all-text daily file in the health schema's 67-column layout,
    derived from ``lineitem``: one row per line item, keyed by supplier and ship day, so
    several rows share a key and the dedup has real work.

    Cell ``i`` is present when the line's discount reaches a per-column threshold
    (0.00 … 0.09, from the column's position), so every column is sparse in its own way.
    Each row formats a few values once — price and tax as two-decimal text (built from
    integer cents, so every engine writes the same text), the quantity as an integer and
    as ``x.5`` — and each column takes the one that fits its target type.
    """
    from stellate.plans import health as H

    def money(c: str) -> Column:
        cents = F.round(F.col(c) * F.lit(100.0)).cast("bigint")
        return F.concat(
            F.floor(cents / F.lit(100)).cast("bigint").cast("string"),
            F.lit("."),
            F.lpad(F.pmod(cents, F.lit(100)).cast("string"), 2, "0"),
        )

    base = {
        "label": F.concat(F.lit("Supplier "), F.col("l_suppkey").cast("string")),
        "text": F.concat(F.col("l_returnflag"), F.lit("-"), F.col("l_linestatus")),
        "bigint": F.col("l_quantity").cast("bigint").cast("string"),
        "bigint_round": (F.col("l_quantity") + F.lit(0.5)).cast("string"),
        "price": money("l_extendedprice"),
        "tax": money("l_tax"),
    }
    cols = [
        F.concat(F.lit("S"), F.col("l_suppkey").cast("string")).alias(H.ENTITY),
        F.to_date("l_shipdate").cast("string").alias(H.DATE),
    ]
    # A projection of its own: inside the cells' conditions each cell would format its value again.
    formatted = lineitem.select(*cols, "l_discount", *[v.alias(f"__{n}") for n, v in base.items()])
    cells = []
    for _, name, value, threshold in health_cells():
        present = F.lit(True) if threshold is None else F.col("l_discount") >= F.lit(threshold)
        cells.append(F.when(present, F.col(f"__{value}")).otherwise(F.lit("")).alias(name))
    return formatted.select(H.ENTITY, H.DATE, *cells)


def health_cells() -> list[tuple[int, str, str, float | None]]:
    """(position, source column, base value, presence threshold) of every non-key cell of
    ``health_wide_view``. Base values: ``label``, ``text``, ``bigint``, ``bigint_round``,
    and ``price`` / ``tax`` alternating over the DOUBLE columns. The label is always
    present (threshold ``None``)."""
    from stellate.plans import health as H

    kinds = {c.source: c.kind for m in (H.LOCATII, *H.FACTS) for c in m.columns}
    out = []
    for i, name in enumerate(c for c in H.SOURCE_COLUMNS if c not in (H.ENTITY, H.DATE)):
        if name == H.LABEL:
            value, threshold = "label", None
        else:
            kind = kinds[name]
            value = ("price" if i % 2 == 0 else "tax") if kind == "double" else kind
            threshold = round(0.01 * ((i * 3) % 10), 2)
        out.append((i, name, value, threshold))
    return out
