"""Named queries over the driver tables, each with an independent SQL oracle.

Every entry reads whole tables (or frames Spark derives from them); none uses
row caps or id subsets. ``LIMIT`` appears only where top-k *is* the operator.
The Spark side is built from library operators; the oracle side is hand-written
DuckDB SQL with the same column names and types. Outputs use BIGINT, INT,
DOUBLE, STRING, BOOLEAN and TIMESTAMP only: DATE and DECIMAL values convert to
different Python/pandas types from the two engines, so days are emitted as
midnight timestamps and money as exact two-decimal doubles.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import columns as C
from ..functions.numeric import cents, exact_mean, exact_sum, flag_sum, from_cents, pct, rounded
from ..operators import aggregates as A
from ..operators import hierarchy as H
from ..operators import quality as Q
from ..operators import quantiles as N
from ..operators import sampling as P
from ..operators import sequence as S
from ..operators import windows as W
from ..operators.joins import sized_broadcast
from ..session import ensure_checkpoint_dir
from ..sources.files import Tables
from . import oracle as o

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def _fin():
    return F.col("o_orderstatus") == "F"


def _all():
    return F.count(F.lit(1))

# Fixed values of the query catalogue (thresholds and labels chosen for the data).
PRICE_TIERS = [(100000.0, "budget"), (250000.0, "standard"), (400000.0, "premium")]
PRICE_TOP = "luxury"
QTY_BANDS = [(10.0, "small"), (30.0, "medium")]
QTY_TOP = "large"
VALUE_BANDS = [(10.0, "low"), (100.0, "mid")]
VALUE_TOP = "high"
BALANCE_TIERS = [(1702.0, "low"), (4297.0, "mid"), (7360.0, "high")]
BALANCE_TOP = "top"
SEGMENT_RANK = {"AUTOMOBILE": 1, "BUILDING": 2, "FURNITURE": 3, "HOUSEHOLD": 4}
PART_CATEGORIES = [(["hot", "cold"], "Thermal"), (["widget", "gizmo"], "Gadget"),
                   (["bolt", "rod", "ring"], "Fastener"), (["gear", "plate"], "Mechanical")]
ACCEPTED_PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM"]
RUN_TS = "2024-01-01 00:00:00"
AS_OF = "2024-02-01 00:00:00"


def _case_lt(col: str, edges, top: str) -> str:
    parts = " ".join(f"WHEN {col} < {e} THEN '{v}'" for e, v in edges)
    return f"CASE {parts} ELSE '{top}' END"


def _t(spark: SparkSession, base: str) -> Tables:
    return Tables(spark, base)


# ============================================================ marts (A-*, M-*)

def order_class_summary(orders: DataFrame, key: str = "o_orderpriority",
                        status: str = "o_orderstatus", price: str = "o_totalprice") -> DataFrame:
    """Per-class mart (M-2/M-5): totals, finished/open, rate, mean, status counts."""
    fin = F.col(status) == "F"
    return A.summarise(orders, [key], {
        "total_orders": _all(),
        "finished_orders": F.count_if(fin),
        "open_orders": F.sum(F.lit(1) - fin.cast("int")).cast("long"),
        "finished_pct": pct(F.count_if(fin), _all()),
        "avg_price": rounded(exact_mean(price), 2),
        "total_price": exact_sum(price),
        "pending_orders": F.count_if(F.col(status) == "P"),
    })


CLASS_SUMMARY_SQL = f"""
SELECT o_orderpriority,
       COUNT(*) AS total_orders,
       {o.cnt("o_orderstatus = 'F'")} AS finished_orders,
       CAST(SUM(1 - CAST(o_orderstatus = 'F' AS INTEGER)) AS BIGINT) AS open_orders,
       {o.pct(o.cnt("o_orderstatus = 'F'"), "COUNT(*)")} AS finished_pct,
       {o.r(o.mean("o_totalprice"), 2)} AS avg_price,
       {o.money_sum("o_totalprice")} AS total_price,
       {o.cnt("o_orderstatus = 'P'")} AS pending_orders
FROM orders GROUP BY o_orderpriority"""


@query("class_summary", CLASS_SUMMARY_SQL)
def class_summary(spark, base):
    """Per order priority: totals, finished/open/pending counts, finished %, mean and total price (M-2/M-5, A-3, A-6, A-9, A-10, A-18)."""
    return order_class_summary(_t(spark, base).orders)


def _with_price_tier(orders: DataFrame) -> DataFrame:
    return orders.withColumn("price_tier", C.thresholds("o_totalprice", PRICE_TIERS, PRICE_TOP))


@query("segment_rates", " UNION ALL ".join(
    f"""SELECT '{dim}' AS dimension, CAST({expr} AS VARCHAR) AS segment, COUNT(*) AS total,
               {o.cnt("o_orderstatus = 'F'")} AS finished,
               {o.pct(o.cnt("o_orderstatus = 'F'"), "COUNT(*)")} AS finished_pct
        FROM orders GROUP BY 2"""
    for dim, expr in [("status", "o_orderstatus"), ("priority", "o_orderpriority"),
                      ("price_tier", _case_lt("o_totalprice", PRICE_TIERS, PRICE_TOP))]))
def segment_rates(spark, base):
    """Finished counts and rate per status, priority and price tier, stacked with GROUPING SETS (A-17, M-6)."""
    o_ = _with_price_tier(_t(spark, base).orders)
    return A.segment_rates(
        o_, {"status": "o_orderstatus", "priority": "o_orderpriority", "price_tier": "price_tier"},
        {"total": _all(), "finished": F.count_if(_fin()), "finished_pct": pct(F.count_if(_fin()), _all())})


@query("union_all", " UNION ALL ".join(
    f"""SELECT '{src}' AS source, {p}_nationkey AS nationkey, COUNT(*) AS n_accounts,
               {o.money_sum(p + '_acctbal')} AS total_balance,
               {o.r(o.mean(p + '_acctbal'), 2)} AS avg_balance
        FROM {src} GROUP BY {p}_nationkey"""
    for src, p in [("customer", "c"), ("supplier", "s")]))
def union_all(spark, base):
    """Account counts and balances per nation for customers and suppliers, tagged and unioned (U-1)."""
    t = _t(spark, base)

    def by_nation(df, p):
        return df.groupBy(F.col(f"{p}_nationkey").alias("nationkey")).agg(
            _all().alias("n_accounts"), exact_sum(f"{p}_acctbal").alias("total_balance"),
            rounded(exact_mean(f"{p}_acctbal"), 2).alias("avg_balance"))
    return A.union_tagged({"customer": by_nation(t.customer, "c"),
                           "supplier": by_nation(t.supplier, "s")})


@query("rate_by_group", f"""
SELECT l_linestatus, {_case_lt('l_quantity', QTY_BANDS, QTY_TOP)} AS qty_band,
       COUNT(*) AS total_items,
       {o.flag("l_returnflag = 'R'")} AS total_failed,
       {o.flag("NOT (l_returnflag = 'R')")} AS total_passed,
       {o.pct(o.flag("l_returnflag = 'R'"), "COUNT(*)")} AS fail_rate_pct,
       {o.r(o.mean('l_discount'), 4)} AS avg_discount,
       MAX(l_quantity) AS max_quantity
FROM lineitem WHERE l_returnflag IN ('R', 'A') GROUP BY 1, 2""")
def rate_by_group(spark, base):
    """Return-flag 'R' as failure: counts, rate, mean discount, max quantity by line status x quantity band (A-8, A-10, P-10, M-11)."""
    li = _t(spark, base).lineitem.filter(F.col("l_returnflag").isin("R", "A"))
    failed = F.col("l_returnflag") == "R"
    li = li.withColumn("qty_band", C.thresholds("l_quantity", QTY_BANDS, QTY_TOP))
    return A.summarise(li, ["l_linestatus", "qty_band"], {
        "total_items": _all(),
        "total_failed": flag_sum(failed),
        "total_passed": flag_sum(~failed),
        "fail_rate_pct": pct(flag_sum(failed), _all()),
        "avg_discount": rounded(exact_mean("l_discount"), 4),
        "max_quantity": F.max("l_quantity"),
    })


@query("yearly_trends", f"""
SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS total_orders,
       {o.cnt("o_orderstatus = 'F'")} AS finished_orders,
       {o.pct(o.cnt("o_orderstatus = 'F'"), "COUNT(*)")} AS finished_pct,
       COUNT(DISTINCT o_custkey) AS unique_customers,
       {o.flag("o_orderpriority = '1-URGENT'")} AS urgent_orders
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 GROUP BY 1""")
def yearly_trends(spark, base):
    """Per order year 1996-2000: totals, finished %, distinct customers, urgent orders (A-5, P-11, M-12)."""
    # the year range as a timestamp range reaches the Parquet scan as PushedFilters
    o_ = _t(spark, base).orders.filter(
        (F.col("o_orderdate") >= F.lit("1996-01-01").cast("timestamp_ntz"))
        & (F.col("o_orderdate") < F.lit("2001-01-01").cast("timestamp_ntz")))
    o_ = o_.withColumn("order_year", F.year("o_orderdate").cast("int"))
    return A.summarise(o_, ["order_year"], {
        "total_orders": _all(),
        "finished_orders": F.count_if(_fin()),
        "finished_pct": pct(F.count_if(_fin()), _all()),
        "unique_customers": F.count_distinct("o_custkey"),
        "urgent_orders": flag_sum(F.col("o_orderpriority") == "1-URGENT"),
    })


TOP_ENTITY_KEYS = ["n_name", "c_mktsegment", "o_orderpriority", "order_year"]


@query("top_entities", f"""
SELECT n_name, c_mktsegment, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS order_year,
       COUNT(*) AS total_orders,
       {o.flag("o_orderstatus = 'F'")} AS total_finished,
       {o.flag("NOT (o_orderstatus = 'F')")} AS total_open,
       {o.pct(o.flag("o_orderstatus = 'F'"), "COUNT(*)")} AS finished_pct,
       {o.r(o.mean('o_totalprice'), 2)} AS avg_price,
       MAX(o_orderdate) AS last_order_date
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1, 2, 3, 4 HAVING COUNT(*) >= 3
ORDER BY total_open DESC, finished_pct ASC, n_name, c_mktsegment, o_orderpriority, order_year
LIMIT 50""")
def top_entities(spark, base):
    """Top 50 (nation, segment, priority, year) groups with >= 3 orders by open orders, keys as tie-breakers (A-11, A-14, O-1, O-2, M-13)."""
    t = _t(spark, base)
    cust = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    j = (t.orders.join(cust, F.col("o_custkey") == F.col("c_custkey"))
         .join(sized_broadcast(t.nation.select("n_nationkey", "n_name")),
               F.col("c_nationkey") == F.col("n_nationkey"))
         .withColumn("order_year", F.year("o_orderdate").cast("int")))
    stats = A.summarise(j, TOP_ENTITY_KEYS, {
        "total_orders": _all(),
        "total_finished": flag_sum(_fin()),
        "total_open": flag_sum(~_fin()),
        "finished_pct": pct(flag_sum(_fin()), _all()),
        "avg_price": rounded(exact_mean("o_totalprice"), 2),
        "last_order_date": F.max("o_orderdate"),
    }, having=F.col("total_orders") >= 3)
    return W.top_k(stats, [F.col("total_open").desc(), F.col("finished_pct").asc(),
                           *TOP_ENTITY_KEYS], 50)


@query("top_ranked_groups", f"""
WITH s AS (
  SELECT c_name, c_mktsegment, COUNT(*) AS total_orders,
         {o.flag("NOT (o_orderstatus = 'F')")} AS open_orders,
         {o.r(o.mean('o_totalprice'), 2)} AS avg_price
  FROM orders JOIN customer ON o_custkey = c_custkey
  GROUP BY 1, 2 HAVING COUNT(*) >= 3)
SELECT * FROM (
  SELECT *, CAST(RANK() OVER (PARTITION BY c_mktsegment ORDER BY open_orders DESC) AS INTEGER)
         AS rank_in_segment FROM s) WHERE rank_in_segment <= 3""")
def top_ranked_groups(spark, base):
    """Customers with >= 3 orders ranked by open orders within their segment, rank <= 3 with ties (W-11)."""
    t = _t(spark, base)
    # orders are summed by customer before the join, which then moves a row per customer
    per = t.orders.groupBy("o_custkey").agg(
        _all().alias("_n"), flag_sum(~_fin()).alias("_open"),
        F.sum(cents("o_totalprice")).alias("_cents"), F.count("o_totalprice").alias("_priced"))
    j = per.join(t.customer.select("c_custkey", "c_name", "c_mktsegment"),
                 F.col("o_custkey") == F.col("c_custkey"))
    stats = A.summarise(j, ["c_name", "c_mktsegment"], {
        "total_orders": F.sum("_n"),
        "open_orders": F.sum("_open"),
        "avg_price": rounded(F.try_divide(from_cents(F.sum("_cents")), F.sum("_priced").cast("double")), 2),
    }, having=F.col("total_orders") >= 3)
    return W.top_n_per_group(stats, ["c_mktsegment"], [F.col("open_orders").desc()], 3,
                             rank_name="rank_in_segment")


@query("two_key_count", f"""
SELECT event_type, {_case_lt('value', VALUE_BANDS, VALUE_TOP)} AS value_band, COUNT(*) AS n_events
FROM events GROUP BY 1, 2""")
def two_key_count(spark, base):
    """Events per event type x value band (A-12, M-8)."""
    e = _t(spark, base).events.withColumn(
        "value_band", C.thresholds("value", VALUE_BANDS, VALUE_TOP))
    return e.groupBy("event_type", "value_band").agg(_all().alias("n_events"))


# ============================================================ null handling (A-13, P-4, J-3)

DOC_LABEL_COLS = ["doc_id", "text", "lang", "source", "n_chars", "quality", "toxic"]
DOC_LABELS_SQL = """SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, l.quality, l.toxic
    FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""


def documents_labels(t: Tables, nulls_only: bool = False) -> DataFrame:
    """documents LEFT JOIN labels; with ``nulls_only`` the document columns are
    reduced to NULL markers before the join, so the text is never shuffled."""
    docs = t.documents
    if nulls_only:
        docs = A.nullness(docs, keep=["doc_id"])
    return docs.join(t.labels, "doc_id", "left").select(*DOC_LABEL_COLS)


@query("null_profile", f"WITH j AS ({DOC_LABELS_SQL}) SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {o.cnt(c + ' IS NULL')} AS n_null FROM j"
    for c in DOC_LABEL_COLS) + ") WHERE n_null > 0")
def null_profile(spark, base):
    """NULL count per column of documents LEFT JOIN labels, columns with NULLs only (A-13)."""
    return A.null_profile(documents_labels(_t(spark, base), nulls_only=True))


@query("sparse_columns", f"WITH j AS ({DOC_LABELS_SQL}) SELECT * FROM (" + " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, {o.cnt(c + ' IS NULL')} AS n_null, COUNT(*) AS n_rows,
               {o.r(f"CAST({o.cnt(c + ' IS NULL')} AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)", 4)}
               AS null_ratio FROM j""" for c in DOC_LABEL_COLS) + ") WHERE n_null > n_rows * 0.5")
def sparse_columns(spark, base):
    """Columns of documents LEFT JOIN labels whose NULL ratio is above 0.5 (P-4)."""
    return A.sparse_columns(documents_labels(_t(spark, base), nulls_only=True), 0.5)


@query("left_join_nulls", f"""
SELECT d.lang, COUNT(*) AS n_docs, COUNT(l.quality) AS n_labelled,
       CAST(SUM(COALESCE(l.toxic, 0)) AS BIGINT) AS n_toxic,
       {o.pct("COUNT(l.quality)", "COUNT(*)")} AS labelled_pct
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id GROUP BY d.lang""")
def left_join_nulls(spark, base):
    """Per language: documents, labelled documents, toxic count with NULL as 0, labelled % (J-3, F-4, A-2)."""
    t = _t(spark, base)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return j.groupBy("lang").agg(
        _all().alias("n_docs"), F.count("quality").alias("n_labelled"),
        F.sum(C.fill_const("toxic", 0)).cast("long").alias("n_toxic"),
        pct(F.count("quality"), _all()).alias("labelled_pct"))


@query("fill_median", f"""
SELECT c_custkey, c_acctbal,
       {o.r("COALESCE(CASE WHEN c_acctbal >= 0 THEN c_acctbal END, "
             "(SELECT median(c_acctbal) FROM customer WHERE c_acctbal >= 0))", 2)} AS balance_filled
FROM customer""")
def fill_median(spark, base):
    """Negative balances set to NULL, then filled with the exact median of the rest (A-4, F-4, M-1)."""
    c = _t(spark, base).customer.withColumn(
        "_bal", C.null_if("c_acctbal", F.col("c_acctbal") < 0))
    med = N.quantile(c, "_bal").scalar()
    return c.select("c_custkey", "c_acctbal",
                    rounded(F.coalesce(F.col("_bal"), med), 2).alias("balance_filled"))


@query("median_by_group", f"""
SELECT l_returnflag, l_linestatus, {o.r("(MIN(v) + MAX(v)) / 2.0", 4)} AS median_price FROM (
  SELECT l_returnflag, l_linestatus, l_extendedprice AS v,
         ROW_NUMBER() OVER (PARTITION BY l_returnflag, l_linestatus ORDER BY l_extendedprice) AS i,
         COUNT(*) OVER (PARTITION BY l_returnflag, l_linestatus) AS n FROM lineitem)
WHERE i IN ((n + 1) // 2, n // 2 + 1) GROUP BY ALL""")
def median_by_group(spark, base):
    """Exact median price of each return flag and line status, by narrowing (A-4)."""
    out = N.group_quantile(_t(spark, base).lineitem, ["l_returnflag", "l_linestatus"], "l_extendedprice", 0.5, "_m")
    return out.select("l_returnflag", "l_linestatus", rounded(F.col("_m"), 4).alias("median_price"))


@query("sample_rows", """
SELECT event_id, user_id, event_type FROM events
ORDER BY md5('7:' || CAST(event_id AS VARCHAR)), event_id LIMIT 100""")
def sample_rows(spark, base):
    """A repeatable sample of 100 events (O-3)."""
    return P.sample_rows(_t(spark, base).events.select("event_id", "user_id", "event_type"), 100, ["event_id"], seed=7)


@query("sample_by_group", """
SELECT o_orderpriority, o_orderkey, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_orderpriority
                           ORDER BY md5('7:' || CAST(o_orderkey AS VARCHAR)), o_orderkey) <= 20""")
def sample_by_group(spark, base):
    """A repeatable sample of 20 orders of each priority (O-3, S-10)."""
    rows = _t(spark, base).orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return P.sample_rows(rows, 20, ["o_orderkey"], seed=7, strata=["o_orderpriority"])


@query("csv_rejects", """
SELECT reason, COUNT(*) AS n_lines, CAST(SUM(event_id) AS BIGINT) AS id_sum FROM (
  SELECT event_id, CASE WHEN event_type = 'error' THEN 'short: 2 of 4 fields'
                        WHEN event_type = 'purchase' THEN 'long: 5 of 4 fields'
                        WHEN value < 1 THEN 'value is no double' ELSE 'accepted' END AS reason FROM events)
GROUP BY reason""")
def csv_rejects(spark, base):
    """Events as CSV lines, damaged by their kind, read back into typed rows and rejects with a reason (S-1, S-2)."""
    from ..sources.rejects import split_csv
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/lines-{uuid.uuid4().hex}"
    e = _t(spark, base).events
    field = lambda c: F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"'))
    value = F.when(F.col("value") < 1, F.lit("n/a")).otherwise(F.col("value").cast("string"))
    whole = F.concat_ws(",", F.col("event_id").cast("string"), field("event_type"), value, field("props"))
    line = (F.when(F.col("event_type") == "error", F.concat_ws(",", F.col("event_id").cast("string"), field("event_type")))
            .when(F.col("event_type") == "purchase", F.concat(whole, F.lit(",extra"))).otherwise(whole))
    # a text file has no header of its own: every file begins with one
    e.select(line.alias("event_id,event_type,value,props")).write.option("header", True).option("quote", "\u0000") \
        .option("escapeQuotes", False).option("sep", "\u0001").csv(path)
    both = split_csv(spark, path, "event_id long, event_type string, value double, props string", f"{path}-split")
    bad = both.rejected.select(F.col("_reason").alias("reason"),
                               F.regexp_extract("_raw", r"^(\d+)", 1).cast("long").alias("event_id"))
    rows = both.accepted.select(F.lit("accepted").alias("reason"), "event_id").unionByName(bad)
    return rows.groupBy("reason").agg(_all().alias("n_lines"), F.sum("event_id").alias("id_sum"))


@query("ratio_column", f"""
SELECT l_orderkey, l_linenumber, l_extendedprice, l_discount,
       {o.r("l_extendedprice / NULLIF(l_discount, 0)", 2)} AS price_per_discount
FROM lineitem""")
def ratio_column(spark, base):
    """Extended price per discount with NULL instead of a division by zero (F-13, M-1)."""
    li = _t(spark, base).lineitem
    return li.select("l_orderkey", "l_linenumber", "l_extendedprice", "l_discount",
                     rounded(F.try_divide("l_extendedprice", "l_discount"), 2)
                     .alias("price_per_discount"))


# ============================================================ cleaning (P-*, F-*)

SILVER_ORDER_NAMES = {"o_orderkey": "order_key", "o_custkey": "customer_key",
                      "o_orderstatus": "status", "o_totalprice": "total_price",
                      "o_orderdate": "order_date"}


@query("silver_orders", f"""
SELECT o_orderkey AS order_key, o_custkey AS customer_key, o_orderstatus AS status,
       CAST(ROUND(CAST(o_totalprice AS DECIMAL(38,10)), 2) AS DOUBLE) AS total_price,
       CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_date,
       {o.r("o_totalprice / 1000.0", 1)} AS price_k,
       o_orderstatus = 'F' AS is_finished
FROM orders""")
def silver_orders(spark, base):
    """Orders renamed, priority dropped, price rounded as money, date cast, finished flag (P-1, P-3, P-5, F-12, M-3)."""
    s = C.rename(_t(spark, base).orders, SILVER_ORDER_NAMES, drop=["o_orderpriority"])
    return s.select("order_key", "customer_key", "status",
                    C.money_round("total_price", 2).cast("double").alias("total_price"),
                    F.to_date("order_date").cast("timestamp_ntz").alias("order_date"),
                    rounded(F.col("total_price") / F.lit(1000.0), 1).alias("price_k"),
                    (F.col("status") == "F").alias("is_finished"))


@query("bucketise", f"""
SELECT c_custkey, c_acctbal,
       {_case_lt('c_acctbal', BALANCE_TIERS, BALANCE_TOP)} AS balance_tier,
       CASE WHEN c_acctbal < 0 THEN 'in debt' WHEN c_acctbal = 0 THEN 'zero'
            ELSE 'in credit' END AS balance_label,
       CASE {' '.join(f"WHEN c_mktsegment = '{k}' THEN {v}" for k, v in SEGMENT_RANK.items())}
            ELSE 99 END AS segment_rank
FROM customer""")
def bucketise(spark, base):
    """Balance tier, balance label and segment rank with a 99 default (F-15, F-17, M-4)."""
    c = _t(spark, base).customer
    return c.select(
        "c_custkey", "c_acctbal",
        C.thresholds("c_acctbal", BALANCE_TIERS, BALANCE_TOP).alias("balance_tier"),
        C.bucketise([(F.col("c_acctbal") < 0, "in debt"), (F.col("c_acctbal") == 0, "zero")],
                    "in credit").alias("balance_label"),
        C.code_map("c_mktsegment", SEGMENT_RANK, 99).cast("int").alias("segment_rank"))


@query("enriched_events", f"""
SELECT *, {_case_lt('value', VALUE_BANDS, VALUE_TOP)} AS value_band,
       event_type = 'error' AS is_error, value >= 100 AS is_high_value
FROM events""")
def enriched_events(spark, base):
    """All event columns plus value band, error flag, high-value flag (P-8, F-16, M-10)."""
    e = _t(spark, base).events
    return e.select("*", C.thresholds("value", VALUE_BANDS, VALUE_TOP).alias("value_band"),
                    (F.col("event_type") == "error").alias("is_error"),
                    (F.col("value") >= 100).alias("is_high_value"))


@query("categorise_parts", "SELECT p_partkey, p_name, CASE " + " ".join(
    "WHEN " + " OR ".join(f"p_name ILIKE '%{n}%'" for n in needles) + f" THEN '{label}'"
    for needles, label in PART_CATEGORIES) + " ELSE 'Other' END AS category FROM part")
def categorise_parts(spark, base):
    """First-matching case-insensitive category of each part name (P-13, F-5)."""
    p = _t(spark, base).part
    return p.select("p_partkey", "p_name", C.categorise("p_name", PART_CATEGORIES).alias("category"))


@query("string_clean", """
SELECT p_partkey, upper(trim('  ' || p_name || ' ')) AS name_clean, lower(p_type) AS type_lower,
       upper(trim(COALESCE(p_brand, 'unknown'))) AS brand_clean
FROM part""")
def string_clean(spark, base):
    """Upper/trim of padded names, lower-cased types, defaulted brands (F-1, F-2, M-9)."""
    p = _t(spark, base).part
    return p.select("p_partkey",
                    C.clean_upper(F.concat(F.lit("  "), F.col("p_name"), F.lit(" "))).alias("name_clean"),
                    F.lower("p_type").alias("type_lower"),
                    C.clean_upper(C.fill_const("p_brand", "unknown")).alias("brand_clean"))


@query("initcap_pg", """
SELECT p_partkey, array_to_string(list_transform(regexp_extract_all(
         p_type || '/' || p_name || '-' || p_brand, '([\\pL\\pN]+|[^\\pL\\pN]+)', 1),
         lambda x: upper(x[1]) || lower(x[2:])), '') AS label
FROM part""")
def initcap_pg(spark, base):
    """PostgreSQL-style initcap over type/name/brand text (F-3)."""
    p = _t(spark, base).part
    txt = F.concat(F.col("p_type"), F.lit("/"), F.col("p_name"), F.lit("-"), F.col("p_brand"))
    return p.select("p_partkey", C.pg_initcap(txt).alias("label"))


@query("split_count", """
SELECT doc_id, CAST(CASE WHEN text IS NULL OR trim(text) = '' THEN 0
                    ELSE len(string_split(text, chr(10))) END AS INTEGER) AS n_lines
FROM documents""")
def split_count(spark, base):
    """Lines per document (pieces split on newline; blank text counts 0) (F-7)."""
    d = _t(spark, base).documents
    return d.select("doc_id", C.split_count("text", "\n").cast("int").alias("n_lines"))


@query("date_parts", """
SELECT o_orderkey, strftime(o_orderdate, '%m/%d/%Y') AS order_date_text,
       CAST(strptime(strftime(o_orderdate, '%m/%d/%Y'), '%m/%d/%Y') AS TIMESTAMP) AS order_date,
       CAST(year(o_orderdate) AS INTEGER) AS order_year,
       CAST(month(o_orderdate) AS INTEGER) AS order_month
FROM orders""")
def date_parts(spark, base):
    """Order date formatted as M/d text, parsed back, year and month (F-9, F-10, M-9)."""
    o_ = _t(spark, base).orders.withColumn(
        "order_date_text", F.date_format("o_orderdate", "MM/dd/yyyy"))
    d = C.parse_date("order_date_text", "M/d/yyyy")
    return o_.select("o_orderkey", "order_date_text", d.cast("timestamp_ntz").alias("order_date"),
                     F.year(d).cast("int").alias("order_year"),
                     F.month(d).cast("int").alias("order_month"))


@query("safe_cast", r"""
SELECT p_partkey, TRY_CAST(regexp_extract(p_brand, '#(.*)$', 1) AS INTEGER) AS brand_number,
       p_type IS NOT NULL AND TRY_CAST(p_type AS INTEGER) IS NULL AS type_rejected,
       p_brand IS NOT NULL AND TRY_CAST(p_brand AS INTEGER) IS NULL AS brand_rejected,
       CAST(p_size AS VARCHAR) AS size_text
FROM part""")
def safe_cast(spark, base):
    """Brand number through an ANSI-safe cast, plus reject flags for brand and type text (F-14)."""
    p = _t(spark, base).part
    return p.select("p_partkey",
                    C.safe_cast(F.regexp_extract("p_brand", r"#(.*)$", 1), "int").alias("brand_number"),
                    C.cast_rejected("p_type", "int").alias("type_rejected"),
                    C.cast_rejected("p_brand", "int").alias("brand_rejected"),
                    F.col("p_size").cast("string").alias("size_text"))


@query("filter_project_sort", """
SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 450000
ORDER BY o_totalprice DESC, o_orderkey""")
def filter_project_sort(spark, base):
    """Orders above a price, three columns, sorted (P-7, P-9)."""
    o_ = _t(spark, base).orders
    return (o_.filter(F.col("o_totalprice") > 450000).select("o_orderkey", "o_totalprice", "o_orderdate")
              .orderBy(F.col("o_totalprice").desc(), "o_orderkey"))


@query("param_query", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderstatus = 'F' AND o_totalprice > 400000.0""")
def param_query(spark, base):
    """Named-parameter SQL over the orders frame (P-15, S-6)."""
    return spark.sql(
        "SELECT o_orderkey, o_custkey, o_totalprice FROM {orders} "
        "WHERE o_orderstatus = :cls AND o_totalprice > :min_price",
        args={"cls": "F", "min_price": 400000.0}, orders=_t(spark, base).orders)


@query("scan_pruned", f"""
SELECT l_returnflag, COUNT(*) AS n_items, SUM(l_quantity) AS total_qty,
       {o.money_sum('l_extendedprice')} AS total_price
FROM lineitem GROUP BY l_returnflag""")
def scan_pruned(spark, base):
    """Three-column scan of lineitem aggregated by return flag (S-4)."""
    li = _t(spark, base).lineitem.select("l_returnflag", "l_quantity", "l_extendedprice")
    return li.groupBy("l_returnflag").agg(_all().alias("n_items"), F.sum("l_quantity").alias("total_qty"),
                                          exact_sum("l_extendedprice").alias("total_price"))


CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("table_profile", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(DISTINCT {c}) AS n_distinct,
               {len(CUSTOMER_COLS)} AS n_columns FROM customer""" for c in CUSTOMER_COLS))
def table_profile(spark, base):
    """Rows, distinct values and column count for every customer column (S-10)."""
    c = _t(spark, base).customer
    cols = c.columns
    wide = c.agg(_all().alias("n_rows"), *[F.count_distinct(x).alias(x) for x in cols])
    return (wide.unpivot(["n_rows"], cols, "column_name", "n_distinct")
                .select("column_name", "n_rows", "n_distinct",
                        F.lit(len(cols)).alias("n_columns")))


PROFILED = ("o_orderstatus", "o_orderpriority")


@query("profile_merged", " UNION ALL ".join(
    f"""SELECT '{c}' AS column_name, COUNT(*) AS n_rows, COUNT(*) - COUNT({c}) AS n_null,
               COUNT(DISTINCT {c}) AS n_distinct FROM orders""" for c in PROFILED))
def profile_merged(spark, base):
    """Profile of orders merged from the states of its years (S-10); sketches of so few values are exact."""
    from .profiles import merged, partition_states

    rows = _t(spark, base).orders.select(F.year("o_orderdate").alias("o_year"), *PROFILED)
    return merged(partition_states(rows, ["o_year"])).select("column_name", "n_rows", "n_null", "n_distinct")


@query("bronze_stamp", f"""
SELECT *, TIMESTAMP '{RUN_TS}' AS _ingested_at, 'nation.parquet' AS _source_file FROM nation""")
def bronze_stamp(spark, base):
    """Nation rows with a run timestamp and the source file name (K-6)."""
    from .layers import bronze_stamp as stamp
    return stamp(_t(spark, base).nation, RUN_TS)


# ============================================================ windows (W-*, O-*)

@query("first_per_group", """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1""")
def first_per_group(spark, base):
    """First order of every customer by date, then key (W-1, P-16)."""
    o_ = _t(spark, base).orders.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return W.first_per_group(o_, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("rank_dense", """
SELECT * FROM (
  SELECT o_orderpriority, o_orderkey, o_totalprice,
         CAST(RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS INTEGER) AS price_rank,
         CAST(DENSE_RANK() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC) AS INTEGER)
           AS price_dense_rank
  FROM orders) WHERE price_rank <= 10""")
def rank_dense(spark, base):
    """rank and dense_rank of price within priority, rank <= 10 (W-2, W-3)."""
    o_ = _t(spark, base).orders.select("o_orderpriority", "o_orderkey", "o_totalprice")
    return W.top_n_per_group(o_, ["o_orderpriority"], [F.col("o_totalprice").desc()], 10,
                             rank_name="price_rank", dense_name="price_dense_rank")


@query("lag_lead", f"""
SELECT event_id, user_id, ts, value,
       LAG(value) OVER w AS prev_value, LEAD(value) OVER w AS next_value,
       {o.r("value - LAG(value) OVER w", 2)} AS value_change
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def lag_lead(spark, base):
    """Previous/next event value per user and the change, hot-user safe (W-4, W-5, W-6)."""
    e = _t(spark, base).events.select("event_id", "user_id", "ts", "value")
    out = S.lag_lead(e, ["user_id"], ["ts", "event_id"], "value")
    return out.withColumn("value_change", rounded(F.col("value") - F.col("prev_value"), 2))


@query("running_moving", f"""
SELECT event_id, user_id, ts, value,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS DOUBLE) AS running_total,
       {o.r("CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)"
            " / CAST(COUNT(value) OVER (w ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS DOUBLE)", 2)}
         AS moving_avg_3
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def running_moving(spark, base):
    """Running total and 3-row moving mean of event value per user (W-7, W-8)."""
    e = _t(spark, base).events.select("event_id", "user_id", "ts", "value")

    def build(w):
        frame = w.rowsBetween(-2, 0)
        return {"_m": from_cents(F.sum(cents("value")).over(frame))
                / F.count("value").over(frame).cast("double")}
    out = S.sequence_window(e, ["user_id"], ["ts", "event_id"], build, back=2,
                            running={"_run": cents("value")})
    return out.select("event_id", "user_id", "ts", "value",
                      from_cents(F.col("_run")).alias("running_total"),
                      rounded(F.col("_m"), 2).alias("moving_avg_3"))


@query("running_range", """
SELECT event_id, event_type, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_date, value,
       CAST(SUM(CAST(value AS DECIMAL(18,2))) OVER (PARTITION BY event_type ORDER BY CAST(ts AS DATE))
            AS DOUBLE) AS running_total
FROM events""")
def running_range(spark, base):
    """Running total per event type by day, in which the events of a day share one sum (W-7, RANGE frame)."""
    e = _t(spark, base).events.select(
        "event_id", "event_type", F.to_date("ts").cast("timestamp_ntz").alias("event_date"), "value")
    out = S.running_range(e, ["event_type"], ["event_date"], {"_run": cents("value")})
    return out.select("event_id", "event_type", "event_date", "value",
                      from_cents(F.col("_run")).alias("running_total"))


@query("lag_lead_global", """
SELECT o_orderkey, o_orderdate, o_totalprice,
       LAG(o_totalprice) OVER w AS prev_price, LEAD(o_totalprice) OVER w AS next_price
FROM orders WINDOW w AS (ORDER BY o_orderdate, o_orderkey)""")
def lag_lead_global(spark, base):
    """Previous and next price over the whole orders table by date, distributed (W-4, W-5, W-12)."""
    o_ = _t(spark, base).orders.select("o_orderkey", "o_orderdate", "o_totalprice")
    return S.lag_lead(o_, [], ["o_orderdate", "o_orderkey"], "o_totalprice",
                      lag_name="prev_price", lead_name="next_price")


@query("ntile_global", """
SELECT c_custkey, c_acctbal, CAST(NTILE(4) OVER (ORDER BY c_acctbal, c_custkey) AS INTEGER) AS balance_quartile
FROM customer""")
def ntile_global(spark, base):
    """Balance quartile over the whole customer table, distributed (W-9, W-12)."""
    c = _t(spark, base).customer.select("c_custkey", "c_acctbal")
    return S.global_ntile(c, ["c_acctbal", "c_custkey"], 4, "balance_quartile")


@query("diff_from_avg", f"""
WITH m AS (SELECT o_orderpriority, {o.mean('o_totalprice')} AS mean FROM orders GROUP BY 1)
SELECT o_orderkey, o.o_orderpriority, o_totalprice, {o.r('mean', 2)} AS class_avg_price,
       {o.r('o_totalprice - mean', 2)} AS diff_from_avg
FROM orders o JOIN m ON o.o_orderpriority = m.o_orderpriority
ORDER BY o_totalprice - mean DESC, o_orderkey LIMIT 10""")
def diff_from_avg(spark, base):
    """Top 10 orders by price above their priority's mean (W-10, O-2)."""
    o_ = _t(spark, base).orders.select("o_orderkey", "o_orderpriority", "o_totalprice")
    return W.top_k_diff_from_mean(o_, ["o_orderpriority"], "o_totalprice", "o_orderkey", 10,
                                  "class_avg_price", "diff_from_avg")


@query("newest_n", """
SELECT event_id, ts, user_id, event_type, value FROM events ORDER BY ts DESC, event_id DESC LIMIT 8""")
def newest_n(spark, base):
    """The 8 newest events (O-4, G-4)."""
    e = _t(spark, base).events.select("event_id", "ts", "user_id", "event_type", "value")
    return W.top_k(e, [F.col("ts").desc(), F.col("event_id").desc()], 8)


LINEITEM_REST = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
                 "l_returnflag", "l_linestatus", "l_shipdate"]


@query("dedup_lineitem", f"""
SELECT * FROM lineitem QUALIFY ROW_NUMBER() OVER (
  PARTITION BY l_orderkey, l_linenumber ORDER BY {', '.join(LINEITEM_REST)}) = 1""")
def dedup_lineitem(spark, base):
    """One line per (order, line number), chosen by a total order over the other columns (U-3, S16)."""
    return W.dedup(_t(spark, base).lineitem, ["l_orderkey", "l_linenumber"], LINEITEM_REST)


# ============================================================ recursion (R-*, U-2)

ORG_EDGES_SQL = """
  SELECT r_name AS name, CAST(NULL AS VARCHAR) AS parent_name, 'region' AS role FROM region
  UNION ALL SELECT n_name, r_name, 'nation' FROM nation JOIN region ON n_regionkey = r_regionkey
  UNION ALL SELECT c_name, n_name, 'customer' FROM customer JOIN nation ON c_nationkey = n_nationkey"""


@query("org_chart", f"""
WITH RECURSIVE edges AS ({ORG_EDGES_SQL}),
walk AS (
  SELECT name, parent_name, role, 0 AS depth, name AS path FROM edges WHERE parent_name IS NULL
  UNION ALL
  SELECT e.name, e.parent_name, e.role, w.depth + 1, w.path || ' → ' || e.name
  FROM edges e JOIN walk w ON e.parent_name = w.name)
SELECT depth, name, role, path FROM walk""")
def org_chart(spark, base):
    """Region -> nation -> customer walk with depth and path (R-2, J-1, F-6)."""
    t = _t(spark, base)
    region = t.region
    nation = t.nation
    roots = region.select(F.col("r_name").alias("name"), F.lit(None).cast("string").alias("parent_name"),
                          F.lit("region").alias("role"))
    nations = nation.join(sized_broadcast(region), F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("name"), F.col("r_name").alias("parent_name"), F.lit("nation").alias("role"))
    customers = t.customer.join(sized_broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("c_name").alias("name"), F.col("n_name").alias("parent_name"), F.lit("customer").alias("role"))
    edges = roots.unionByName(nations).unionByName(customers)
    walk = H.walk_paths(edges, node="name", parent="parent_name", label="name")
    return walk.select("depth", "name", "role", "path")


@query("turn_chain", """
WITH RECURSIVE walk AS (
  SELECT conv_id, turn, role, 0 AS depth, role AS path FROM conversations WHERE turn = 0
  UNION ALL
  SELECT c.conv_id, c.turn, c.role, w.depth + 1, w.path || ' > ' || c.role
  FROM conversations c JOIN walk w ON c.conv_id = w.conv_id AND c.turn = w.turn + 1)
SELECT conv_id, turn, role, depth, path FROM walk""")
def turn_chain(spark, base):
    """Conversation turn chains walked from turn 0 with depth and role path (R-2)."""
    cv = _t(spark, base).conversations
    key = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    parent = F.when(F.col("turn") > 0, F.concat_ws(
        ":", F.col("conv_id").cast("string"), (F.col("turn") - 1).cast("string")))
    # turn 0 has no parent, so it is the root of each conversation's chain
    edges = cv.select("conv_id", "turn", "role", key.alias("_node"), parent.alias("_parent"))
    walk = H.walk_paths(edges, node="_node", parent="_parent", label="role", separator=" > ")
    return walk.select("conv_id", "turn", "role", "depth", "path")


@query("sequence_cte", """
WITH RECURSIVE bounds AS (
  SELECT CAST(min(year(o_orderdate)) AS INTEGER) AS lo, CAST(max(year(o_orderdate)) AS INTEGER) AS hi
  FROM orders),
years(order_year) AS (
  SELECT lo FROM bounds UNION ALL SELECT order_year + 1 FROM years, bounds WHERE order_year < hi),
counts AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS order_year, COUNT(*) AS n FROM orders GROUP BY 1)
SELECT y.order_year, COALESCE(c.n, 0) AS n_orders FROM years y LEFT JOIN counts c
  ON y.order_year = c.order_year""")
def sequence_cte(spark, base):
    """Year spine from the first to the last order year with order counts, zero-filled (R-1, U-2)."""
    o_ = _t(spark, base).orders.select(F.year("o_orderdate").cast("int").alias("order_year"))
    spine = (o_.agg(F.min("order_year").alias("lo"), F.max("order_year").alias("hi"))
               .select(F.explode(F.sequence("lo", "hi")).alias("order_year")))
    counts = o_.groupBy("order_year").agg(_all().alias("n"))
    # the spine has one row per year in [min, max]: bounded by the calendar
    return (spine.join(counts, "order_year", "left")
                 .select("order_year", F.coalesce("n", F.lit(0)).cast("long").alias("n_orders")))


# ============================================================ data quality (D-*)

def lineitem_metrics(li: DataFrame) -> DataFrame:
    """One metrics row. Rows are first grouped by the line key (combined map-side),
    so the distinct line count is a count of groups and only the order key needs
    a distinct aggregate, instead of an Expand over two distinct aggregates."""
    per_line = li.groupBy("l_orderkey", "l_linenumber").agg(
        _all().alias("_c"),
        F.count_if(F.col("l_orderkey").isNull()).alias("_null"),
        F.count_if(F.col("l_extendedprice") < 0).alias("_neg"),
        F.count_if((F.col("l_discount") < 0) | (F.col("l_discount") > 0.08)).alias("_bad"))
    return Q.metrics(per_line, {
        "total_rows": F.sum("_c").cast("long"),
        "null_orderkeys": F.sum("_null").cast("long"),
        "negative_prices": F.sum("_neg").cast("long"),
        "bad_discounts": F.sum("_bad").cast("long"),
        "unique_orders": F.count_distinct("l_orderkey"),
        "unique_lines": F.count_if(F.col("l_orderkey").isNotNull() & F.col("l_linenumber").isNotNull()),
    })


LINEITEM_METRICS_SQL = """
SELECT COUNT(*) AS total_rows,
       COUNT(*) FILTER (WHERE l_orderkey IS NULL) AS null_orderkeys,
       COUNT(*) FILTER (WHERE l_extendedprice < 0) AS negative_prices,
       COUNT(*) FILTER (WHERE l_discount < 0 OR l_discount > 0.08) AS bad_discounts,
       COUNT(DISTINCT l_orderkey) AS unique_orders,
       COUNT(DISTINCT (l_orderkey, l_linenumber)) AS unique_lines
FROM lineitem"""


@query("dq_metrics", LINEITEM_METRICS_SQL)
def dq_metrics(spark, base):
    """One-pass lineitem metrics: rows, NULL keys, negative prices, bad discounts, distinct orders and lines (D-1, A-1, A-7)."""
    return lineitem_metrics(_t(spark, base).lineitem)


LINEITEM_CHECKS = [
    Q.Check("no_null_orderkeys", "null_orderkeys = 0", "concat(null_orderkeys, ' nulls found')"),
    Q.Check("no_negative_prices", "negative_prices = 0",
            "concat(negative_prices, ' negative prices')"),
    Q.Check("discount_in_range", "bad_discounts = 0",
            "concat(bad_discounts, ' discounts outside 0..0.08')", "warn"),
    Q.Check("unique_order_lines", "unique_lines = total_rows",
            "concat(unique_lines, ' unique of ', total_rows, ' total')"),
]


@query("dq_verdicts", f"WITH m AS ({LINEITEM_METRICS_SQL}) " + " UNION ALL ".join(
    f"SELECT 'lineitem' AS table_name, '{c.name}' AS check_name, {c.rule} AS passed, "
    f"CAST({c.details} AS VARCHAR) AS details, '{c.severity}' AS severity FROM m"
    for c in LINEITEM_CHECKS))
def dq_verdicts(spark, base):
    """Lineitem metrics turned into (check, passed, details, severity) rows (D-2)."""
    return Q.verdicts(lineitem_metrics(_t(spark, base).lineitem), LINEITEM_CHECKS, "lineitem")


@query("dq_status", f"""
WITH m AS ({LINEITEM_METRICS_SQL}), v AS (""" + " UNION ALL ".join(
    f"SELECT {c.rule} AS passed, '{c.severity}' AS severity FROM m" for c in LINEITEM_CHECKS) + """),
n AS (SELECT COUNT(*) FILTER (WHERE NOT passed AND severity = 'error') AS n_errors,
             COUNT(*) FILTER (WHERE NOT passed AND severity = 'warn') AS n_warnings FROM v)
SELECT 'lineitem' AS table_name, n_errors, n_warnings,
       CASE WHEN n_errors > 0 THEN 'failed' WHEN n_warnings > 0 THEN 'dq_warning' ELSE 'success' END AS status
FROM n""")
def dq_status(spark, base):
    """Gate outcome of the lineitem checks: failed, dq_warning or success (D-3, D-4)."""
    return Q.gate_status(Q.verdicts(lineitem_metrics(_t(spark, base).lineitem), LINEITEM_CHECKS, "lineitem"))


@query("min_rows", " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, COUNT(*) >= 100 AS passed FROM {name}" for name in ("orders", "region")))
def min_rows(spark, base):
    """Minimum row guard of 100 rows without a full count (D-13)."""
    t = _t(spark, base)
    return Q.row_guard(t.orders, 100, "orders").unionByName(Q.row_guard(t.region, 100, "region"))


@query("duplicate_count", """
SELECT COUNT(*) AS total_rows, COUNT(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
       COUNT(*) - COUNT(DISTINCT (l_orderkey, l_linenumber)) AS duplicate_rows FROM lineitem""")
def duplicate_count(spark, base):
    """Rows, distinct (order, line) keys and duplicates (A-15)."""
    return A.duplicate_count(_t(spark, base).lineitem, ["l_orderkey", "l_linenumber"])


@query("null_ratio_check", f"""
SELECT 'documents_labels' AS table_name, COUNT(*) AS n_rows,
       COUNT(*) FILTER (WHERE l.quality IS NULL) AS n_null,
       {o.r("CAST(COUNT(*) FILTER (WHERE l.quality IS NULL) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)", 4)}
         AS null_ratio,
       COUNT(*) FILTER (WHERE l.quality IS NULL) <= COUNT(*) * 0.1 AS passed
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""")
def null_ratio_check(spark, base):
    """NULL ratio of labels over documents against a 10% threshold (D-5)."""
    t = _t(spark, base)
    j = t.documents.select("doc_id").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    nulls = F.count_if(F.col("quality").isNull())
    return j.agg(F.lit("documents_labels").alias("table_name"), _all().alias("n_rows"),
                 nulls.alias("n_null"), rounded(nulls / _all(), 4).alias("null_ratio"),
                 (nulls <= _all() * F.lit(0.1)).alias("passed"))


@query("test_unique", """
SELECT l_orderkey, l_linenumber, COUNT(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING COUNT(*) > 1""")
def test_unique(spark, base):
    """Failing rows of a uniqueness test on (order, line number) (D-6)."""
    return Q.test_unique(_t(spark, base).lineitem, ["l_orderkey", "l_linenumber"])


@query("test_not_null", """
SELECT d.doc_id, d.lang FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE l.quality IS NULL""")
def test_not_null(spark, base):
    """Documents without a quality label (D-7)."""
    t = _t(spark, base)
    j = t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left")
    return Q.test_not_null(j, "quality", report=["doc_id", "lang"])


@query("test_accepted", f"""
SELECT o_orderpriority AS value, COUNT(*) AS n_rows FROM orders
WHERE o_orderpriority IS NOT NULL AND o_orderpriority NOT IN
  ({', '.join(f"'{v}'" for v in ACCEPTED_PRIORITIES)}) GROUP BY 1""")
def test_accepted(spark, base):
    """Priorities outside an accepted list, with counts (D-8)."""
    return Q.test_accepted_values(_t(spark, base).orders, "o_orderpriority", ACCEPTED_PRIORITIES)


@query("test_bounds", """
SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal < 0 OR c_acctbal > 9500""")
def test_bounds(spark, base):
    """Customers with a balance outside [0, 9500] (D-9, D-10)."""
    return Q.test_bounds(_t(spark, base).customer, "c_acctbal", 0, 9500,
                         report=["c_custkey", "c_acctbal"])


@query("test_relationships", """
SELECT o_orderkey, o_custkey FROM orders
WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal >= 0)""")
def test_relationships(spark, base):
    """Orders whose customer is not an active (non-negative balance) customer (D-12)."""
    t = _t(spark, base)
    active = t.customer.filter(F.col("c_acctbal") >= 0)
    child = t.orders.select("o_orderkey", "o_custkey")
    return Q.test_relationships(child, "o_custkey", active, "c_custkey")


@query("source_freshness", " UNION ALL ".join(
    f"""SELECT '{tab}' AS table_name, MAX({col}) AS newest_ts,
               CAST(floor(CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX({col})) AS DOUBLE)
                          / 3600000000.0) AS BIGINT) AS age_hours,
               CAST(epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(MAX({col})) AS DOUBLE) / 3600000000.0 > 24.0
                 AS is_stale
        FROM {tab}""" for tab, col in [("events", "ts"), ("orders", "o_orderdate")]))
def source_freshness(spark, base):
    """Newest timestamp, age in hours and stale flag of events and orders (D-17)."""
    t = _t(spark, base)
    return (Q.freshness(t.events, "ts", "events", AS_OF, 24)
            .unionByName(Q.freshness(t.orders, "o_orderdate", "orders", AS_OF, 24)))


@query("reconcile_rows", """
SELECT (SELECT COUNT(*) FROM orders) AS source_rows,
       (SELECT CAST(SUM(n) AS BIGINT) FROM (SELECT COUNT(*) AS n FROM orders GROUP BY o_orderpriority))
         AS mart_rows,
       (SELECT COUNT(*) FROM orders) = (SELECT SUM(n) FROM (SELECT COUNT(*) AS n FROM orders
         GROUP BY o_orderpriority)) AS rows_match""")
def reconcile_rows(spark, base):
    """Source row count against the class mart's total (D-11, J-2)."""
    o_ = _t(spark, base).orders
    return Q.reconcile(o_, order_class_summary(o_), "total_orders")


@query("avg_of_rates", f"""
WITH m AS ({CLASS_SUMMARY_SQL})
SELECT COUNT(*) AS n_segments,
       {o.r("CAST(SUM(CAST(finished_pct AS DECIMAL(18,1))) AS DOUBLE) / CAST(COUNT(*) AS DOUBLE)", 1)}
         AS avg_finished_pct,
       CAST(SUM(total_orders) AS BIGINT) AS total_orders
FROM m""")
def avg_of_rates(spark, base):
    """Unweighted mean of the per-priority finished rates (A-16)."""
    m = order_class_summary(_t(spark, base).orders)
    return m.agg(_all().alias("n_segments"),
                 rounded(F.sum(F.col("finished_pct").cast("decimal(18,1)")).cast("double")
                         / _all().cast("double"), 1).alias("avg_finished_pct"),
                 F.sum("total_orders").cast("long").alias("total_orders"))


@query("volume_class", " UNION ALL ".join(
    f"""SELECT '{name}' AS table_name, COUNT(*) AS n_rows,
               CASE WHEN COUNT(*) = 0 THEN 'empty' WHEN COUNT(*) < 500 THEN 'small' ELSE 'full' END
                 AS volume_class FROM {src}"""
    for name, src in [("region", "region"), ("supplier", "supplier"), ("orders", "orders"),
                      ("orders_negative_price", "orders WHERE o_totalprice < 0")]))
def volume_class(spark, base):
    """empty / small / full per table (D-14)."""
    t = _t(spark, base)
    orders = t.orders.agg(_all().alias("orders"),
                          F.count_if(F.col("o_totalprice") < 0).alias("orders_negative_price"))
    counts = [t.region.agg(F.lit("region").alias("table_name"), _all().alias("n_rows")),
              t.supplier.agg(F.lit("supplier").alias("table_name"), _all().alias("n_rows")),
              # one scan of orders gives both the table and its filtered slice
              orders.unpivot([], ["orders", "orders_negative_price"], "table_name", "n_rows")]
    out = counts[0].unionByName(counts[1]).unionByName(counts[2])
    return out.withColumn("volume_class", Q.volume_class(F.col("n_rows")))


@query("table_checksum", f"""
SELECT COUNT(*) AS n_rows, CAST(SUM(o_orderkey) AS VARCHAR) AS key_sum,
       MAX(o_orderdate) AS max_order_date, {o.money_sum('o_totalprice')} AS price_sum
FROM orders""")
def table_checksum(spark, base):
    """Row count, key sum, newest date and price sum of orders (D-15)."""
    o_ = _t(spark, base).orders
    return o_.agg(_all().alias("n_rows"), F.sum(F.col("o_orderkey").cast("decimal(20,0)")).cast("string").alias("key_sum"),
                  F.max("o_orderdate").alias("max_order_date"),
                  exact_sum("o_totalprice").alias("price_sum"))


# ============================================================ incremental (K-10, K-11)

@query("upsert_latest", """
WITH base AS (SELECT event_id, user_id, event_type, value, ts AS updated_at FROM events),
upd AS (SELECT event_id, user_id, event_type, value + 1.0 AS value, ts + INTERVAL 1 HOUR AS updated_at
        FROM events WHERE event_type = 'error')
SELECT * FROM (SELECT * FROM base UNION ALL SELECT * FROM upd)
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY updated_at DESC) = 1""")
def upsert_latest(spark, base):
    """Error events updated by a change set; the newest version of each event wins (K-11)."""
    from .layers import upsert_latest as upsert
    e = _t(spark, base).events
    current = e.select("event_id", "user_id", "event_type", "value", F.col("ts").alias("updated_at"))
    changes = (e.filter(F.col("event_type") == "error")
                .select("event_id", "user_id", "event_type", (F.col("value") + F.lit(1.0)).alias("value"),
                        (F.col("ts") + F.expr("INTERVAL 1 HOUR")).alias("updated_at")))
    return upsert(current, changes, ["event_id"], ["updated_at"])


@query("upsert_stored", """
WITH base AS (SELECT event_id, user_id, event_type, value, ts AS updated_at FROM events),
upd AS (SELECT event_id, user_id, event_type, value + 1.0 AS value, ts + INTERVAL 30 HOUR AS updated_at
        FROM events WHERE event_type = 'error')
SELECT *, date_trunc('day', updated_at)::TIMESTAMP AS day FROM (SELECT * FROM base UNION ALL SELECT * FROM upd)
QUALIFY ROW_NUMBER() OVER (PARTITION BY event_id ORDER BY updated_at DESC) = 1""")
def upsert_stored(spark, base):
    """Events stored by day with key filters; error events come back 30 hours later and move to another day (K-10, K-11)."""
    from .incremental import create_keyed, merge_into
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/events-{uuid.uuid4().hex}"
    e = _t(spark, base).events.select("event_id", "user_id", "event_type", "value", F.col("ts").alias("updated_at"))
    day = F.to_date("updated_at").alias("day")
    create_keyed(e.select("*", day), path, ["event_id"], ["updated_at"], "day")
    late = (e.filter(F.col("event_type") == "error").withColumn("value", F.col("value") + F.lit(1.0))
             .withColumn("updated_at", F.col("updated_at") + F.expr("INTERVAL 30 HOURS")))
    merge_into(path, late.select("*", day), ["event_id"], ["updated_at"], "day")
    return spark.read.parquet(path).withColumn("day", F.col("day").cast("timestamp_ntz"))


@query("changed_days", """
WITH a AS (SELECT date_trunc('day', ts)::TIMESTAMP AS day, event_id, user_id, event_type, value, ts FROM events),
b AS (SELECT day, event_id, user_id, event_type,
             CASE WHEN value > 350 THEN value + 1.0 ELSE value END AS value, ts FROM a WHERE NOT value < 0.05),
d AS (SELECT DISTINCT day FROM ((SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL
                                (SELECT * FROM b EXCEPT ALL SELECT * FROM a)))
SELECT d.day, (SELECT count(*) FROM a WHERE a.day = d.day) AS n_before,
       (SELECT count(*) FROM b WHERE b.day = d.day) AS n_after FROM d""")
def changed_days(spark, base):
    """Days whose events differ between two versions, found from the table's checksum down by month and day (D-15)."""
    from .incremental import changed_partitions, partition_checksums
    cols = ["event_id", "user_id", "event_type", "value", "ts"]
    old = _t(spark, base).events.select(*cols, F.to_date("ts").alias("day"))
    new = old.filter(~F.coalesce(F.col("value") < F.lit(0.05), F.lit(False))).withColumn(
        "value", F.when(F.col("value") > F.lit(350.0), F.col("value") + F.lit(1.0)).otherwise(F.col("value")))
    found = changed_partitions(partition_checksums(old, "day"), partition_checksums(new, "day"),
                               [lambda c: F.date_trunc("month", c)])
    return found.select(F.col("part").cast("timestamp_ntz").alias("day"), "n_before", "n_after")


@query("late_window", f"""
WITH e AS (SELECT CAST(CAST(ts AS DATE) AS TIMESTAMP) AS event_date, ts, value FROM events),
days AS (SELECT DISTINCT event_date FROM e WHERE ts >= (SELECT MAX(ts) FROM e) - INTERVAL 3 DAY)
SELECT e.event_date, COUNT(*) AS n_events, {o.money_sum('value')} AS total_value
FROM e WHERE e.event_date IN (SELECT event_date FROM days) GROUP BY e.event_date""")
def late_window(spark, base):
    """Daily aggregates recomputed only for days touched by the last 3 days (K-10)."""
    from .layers import affected_partitions
    e = _t(spark, base).events.withColumn("event_date", F.to_date("ts").cast("timestamp_ntz"))
    hit = affected_partitions(e, "ts", "event_date", lookback="3 days")
    return hit.groupBy("event_date").agg(_all().alias("n_events"), exact_sum("value").alias("total_value"))
