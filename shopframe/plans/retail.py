"""Surrogate retail entities over the driver's tables.

Each view exists twice: as a Spark plan (function of ``Tables``) and as a
DuckDB SQL text in ``SQL`` used by the oracle checks. Keep them in step.

Fixed mapping values (chosen for this engine, stated once here):
  part type -> index group: ECONOMY Ladieswear, SMALL Divided, MEDIUM Menswear,
  LARGE Baby/Children, PROMO Sport, STANDARD Other.
  event type -> shop event: view product, click cart, purchase purchase,
  error cancel, signup department.
  order status: returnflag R -> Returned; else orderstatus P Cancelled,
  F Complete, O Shipped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shopframe.functions.exprs import epoch_us
from shopframe.plans.sessions import session_summaries, session_values

INDEX_GROUPS = {"ECONOMY": "Ladieswear", "SMALL": "Divided", "MEDIUM": "Menswear",
                "LARGE": "Baby/Children", "PROMO": "Sport", "STANDARD": "Other"}
EVENT_TYPES = {"view": "product", "click": "cart", "purchase": "purchase",
               "error": "cancel", "signup": "department"}
TRAFFIC = ["Search", "Organic", "Facebook", "Email", "Display", "Search", "Organic"]
SESSION_GAP_US = 12 * 3600 * 1_000_000  # new session after a 12 h gap


def _case(col: str, mapping: dict, default=None):
    expr = None
    for k, v in mapping.items():
        expr = F.when(F.col(col) == k, v) if expr is None else expr.when(F.col(col) == k, v)
    return expr.otherwise(default) if default is not None else expr


def _case_sql(col: str, mapping: dict, default=None) -> str:
    parts = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {col} {parts}{tail} END"


# ---------------------------------------------------------------- fashion retail

def transactions(t) -> DataFrame:
    """Fashion-retail transactions: one row per order line."""
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_extendedprice", "l_linestatus")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.to_date("o_orderdate").alias("t_dat"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("article_id"),
        F.col("l_extendedprice").alias("price"),
        F.when(F.col("l_linestatus") == "O", 2).otherwise(1).alias("sales_channel_id"))


def articles(t) -> DataFrame:
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("article_id"), F.col("p_name").alias("prod_name"),
        F.col("p_type").alias("product_type_name"), F.col("p_brand").alias("product_group_name"),
        _case("p_type", INDEX_GROUPS, "Other").alias("index_group_name"),
        F.when(F.col("p_size") <= 25, "Men").otherwise("Women").alias("department_name"))


def _age(key: str):
    return F.when(F.col(key) % 11 == 0, F.lit(None)).otherwise(F.lit(18) + F.col(key) % 60)


def fashion_customers(t) -> DataFrame:
    c = t["customer"]
    return c.select(
        F.col("c_custkey").alias("customer_id"), _age("c_custkey").alias("age"),
        F.when(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING", "HOUSEHOLD"), "ACTIVE")
         .when(F.col("c_mktsegment") == "FURNITURE", "PRE-CREATE").otherwise("LEFT CLUB")
         .alias("club_member_status"),
        F.when(F.col("c_custkey") % 3 == 0, "Regularly").otherwise("NONE").alias("fashion_news_frequency"),
        F.concat(F.lit("P"), F.col("c_nationkey").cast("string")).alias("postal_code"))


# ---------------------------------------------------------------- online shop

def users(t) -> DataFrame:
    c = t["customer"].select("c_custkey", "c_nationkey", "c_mktsegment")
    n = F.broadcast(t["nation"].select("n_nationkey", "n_name"))  # 25-row dimension
    return c.join(n, c.c_nationkey == n.n_nationkey, "left").select(
        F.col("c_custkey").alias("id"), _age("c_custkey").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.col("n_name").alias("country"), F.col("c_mktsegment").alias("traffic_source"))


def products(t) -> DataFrame:
    p = t["part"]
    return p.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.col("p_brand").alias("category"),
        F.when(F.col("p_size") <= 25, "Men").otherwise("Women").alias("department"),
        F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("retail_price"),
        (F.col("p_retailprice") * (F.lit(0.375) + F.lit(0.0625) * (F.col("p_partkey") % 5))).alias("cost"),
        (F.col("p_partkey") % 10 + 1).alias("distribution_center_id"))


def _status():
    return (F.when(F.col("l_returnflag") == "R", "Returned")
            .when(F.col("o_orderstatus") == "P", "Cancelled")
            .when(F.col("o_orderstatus") == "F", "Complete").otherwise("Shipped"))


def order_items(t) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_linenumber", "l_quantity",
                              "l_extendedprice", "l_returnflag", "l_shipdate")
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"), F.col("l_linenumber").alias("line_no"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("sale_price"),
        _status().alias("status"), F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("shipped_at"),
        F.expr("l_shipdate + make_dt_interval(l_linenumber)").alias("delivered_at"))


def shop_orders(t) -> DataFrame:
    """Orders with their number of lines (pre-aggregated before the join)."""
    n = t["lineitem"].groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("num_of_item"))
    o = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderstatus")
    return o.join(n, o.o_orderkey == n.l_orderkey, "left").select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("user_id"),
        F.col("o_orderdate").alias("created_at"), F.coalesce("num_of_item", F.lit(0)).alias("num_of_item"))


def inventory_items(t) -> DataFrame:
    li = t["lineitem"].select("l_orderkey", "l_partkey", "l_shipdate")
    o = t["orders"].select("o_orderkey", "o_orderdate")
    return li.join(o, li.l_orderkey == o.o_orderkey).select(
        F.col("l_partkey").alias("product_id"), F.col("o_orderdate").alias("created_at"),
        F.col("l_shipdate").alias("sold_at"))


def sessionize(ev: DataFrame, user: str = "uid", ts: str = "ts", tie: str = "event_id",
               gap_us: int = SESSION_GAP_US, bucket: str = "hour") -> DataFrame:
    """Gap sessions without a per-user window over the events.

    A window over the whole history of a user puts a heavy user into one task.
    Here the events are shuffled once, on (user, time bucket); every window is
    over that key and what crosses a bucket edge is carried by small
    per-(user, bucket) summaries joined back on exactly that key (so the event
    side is never shuffled again):
      1. lag inside the bucket; the first row of a bucket takes the last ts of
         the user's previous non-empty bucket;
      2. a session starts when the gap exceeds ``gap_us``;
      3. session start = running max of start ts in the bucket, else the
         session carried in from earlier buckets;
      4. sequence number = rank inside (user, bucket, session), plus, for the
         carried session, its rows in earlier buckets.
    All users take this path; a task holds one user's events of one ``bucket``
    (a ``date_trunc`` unit). Adds ``session_start`` and ``sequence_number``.
    """
    key = [user, "_b"]
    e = ev.withColumn("_b", F.date_trunc(bucket, F.col(ts)))
    wb = Window.partitionBy(*key).orderBy(ts, tie)
    e = e.withColumn("_lag", F.lag(ts).over(wb))

    wu = Window.partitionBy(user).orderBy("_b")  # over buckets of a user: one row per bucket
    s1 = e.groupBy(*key).agg(F.max(ts).alias("_bmax"))
    s1 = s1.select(*key, F.lag("_bmax").over(wu).alias("_prev_bmax"))
    e = e.join(s1, key, "left")
    prev = F.coalesce(F.col("_lag"), F.col("_prev_bmax"))
    e = e.withColumn("_is_start", prev.isNull() | (epoch_us(F.col(ts)) - epoch_us(prev) > gap_us))
    e = e.withColumn("_run_start", F.max(F.when(F.col("_is_start"), F.col(ts))).over(
        wb.rowsBetween(Window.unboundedPreceding, 0)))

    # per bucket: the last start in it, and how many rows each session has in it
    per = e.groupBy(*key, "_run_start").agg(F.count(F.lit(1)).alias("_n"))
    s2 = per.groupBy(*key).agg(F.max("_run_start").alias("_last_start"),
                               F.sum(F.when(F.col("_run_start").isNull(), F.col("_n"))).alias("_n_carried"))
    s2 = s2.withColumn("_carry", F.max("_last_start").over(wu.rowsBetween(Window.unboundedPreceding, -1)))
    # rows of the carried session in earlier buckets: its own start bucket's tail plus carried parts between
    s2 = s2.withColumn("_own_n", F.lit(None).cast("long"))
    tail = per.filter(F.col("_run_start").isNotNull()).select(user, F.col("_run_start").alias("_carry"),
                                                              F.col("_n").alias("_tail"))
    s2 = s2.join(tail, [user, "_carry"], "left")
    # carried rows of the same session in the buckets between its start and this one
    grp = Window.partitionBy(user, "_carry").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    s2 = s2.withColumn("_between", F.coalesce(F.sum("_n_carried").over(grp), F.lit(0)))
    s2 = s2.select(*key, "_carry", (F.coalesce("_tail", F.lit(0)) + F.col("_between")).alias("_before"))
    e = e.join(s2, key, "left")
    e = e.withColumn("session_start", F.coalesce("_run_start", "_carry"))
    ws = Window.partitionBy(*key, "session_start").orderBy(ts, tie)
    e = e.withColumn("sequence_number", (F.row_number().over(ws) + F.when(F.col("_run_start").isNull(),
                                                                          F.col("_before")).otherwise(0)).cast("int"))
    return e.drop("_b", "_lag", "_prev_bmax", "_is_start", "_run_start", "_carry", "_before")


def _raw_events(t) -> DataFrame:
    return t["events"].select(
        "event_id", "ts", F.col("user_id").alias("uid"), F.col("event_type").alias("raw_type"),
        F.nullif(F.regexp_extract("props", r'"k": *([0-9]+)', 1), F.lit("")).cast("long").alias("k"))


def _visitor_session(s: DataFrame, *cols) -> DataFrame:
    return s.select(
        F.when(F.col("uid") % 5 == 0, F.lit(None).cast("long")).otherwise(F.col("uid")).alias("user_id"),
        F.col("uid").alias("visitor_id"),
        F.concat_ws("-", F.col("uid").cast("string"), epoch_us("session_start").cast("string")).alias("session_id"),
        "session_start", *cols)


def _traffic():
    traffic = None
    for i, name in enumerate(TRAFFIC):
        cond = F.col("uid") % 7 == i
        traffic = F.when(cond, name) if traffic is None else traffic.when(cond, name)
    return traffic


def shop_sessions(t) -> DataFrame:
    """One row per session of ``shop_events``, from mergeable summaries (``plans.sessions``)."""
    s = session_summaries(
        _raw_events(t), "uid", "ts", SESSION_GAP_US,
        sums={f"n_{kind}": F.when(F.col("raw_type") == raw, 1).otherwise(0) for raw, kind in EVENT_TYPES.items()},
        maxes={"product_text": F.when(F.col("raw_type") == "view", F.col("k").cast("string"))})
    return _visitor_session(s, "session_end", "n_events", F.col("n_events").cast("int").alias("depth"),
                            *[f"n_{kind}" for kind in EVENT_TYPES.values()], "product_text", _traffic().alias("traffic_source"))


def shop_session_products(t) -> DataFrame:
    """The distinct product uris that each session views."""
    s = session_values(_raw_events(t), "uid", "ts", SESSION_GAP_US, F.col("k"), F.col("raw_type") == "view")
    return _visitor_session(s, F.lit("product").alias("event_type"), F.concat(F.lit("/product/"), F.col("value").cast("string")).alias("uri"))


def shop_events(t) -> DataFrame:
    """Click-stream with sessions, sequence numbers, uris and anonymous users."""
    s = sessionize(_raw_events(t))
    k = F.col("k").cast("string")
    uri = (F.when(F.col("raw_type") == "view", F.concat(F.lit("/product/"), k))
           .when(F.col("raw_type") == "signup", F.concat(
               F.lit("/department/"), F.when(F.col("k") % 2 == 0, "Men").otherwise("Women"),
               F.lit("/category/Brand#"), (F.col("k") % 25 + 1).cast("string")))
           .when(F.col("raw_type") == "click", "/cart")
           .when(F.col("raw_type") == "purchase", "/purchase").otherwise("/cancel"))
    return s.select(
        "event_id",
        F.when(F.col("uid") % 5 == 0, F.lit(None).cast("long")).otherwise(F.col("uid")).alias("user_id"),
        F.col("uid").alias("visitor_id"),
        F.concat_ws("-", F.col("uid").cast("string"),
                    epoch_us("session_start").cast("string")).alias("session_id"),
        "sequence_number",
        _case("raw_type", EVENT_TYPES).alias("event_type"),
        uri.alias("uri"), _traffic().alias("traffic_source"), F.col("ts").alias("created_at"))


# ---------------------------------------------------------------- operations log

LOG_JOBS = ["RUN_ALL", "LOAD_DIM_CUSTOMER", "LOAD_FACT_ORDER", "LOAD_DIM_PRODUCT"]


def etl_log(t) -> DataFrame:
    """An ETL run log derived from ``orders`` (one run per order) for log queries."""
    o = t["orders"]
    job = None
    for i, name in enumerate(LOG_JOBS):
        cond = F.col("o_orderkey") % len(LOG_JOBS) == i
        job = F.when(cond, name) if job is None else job.when(cond, name)
    start = F.col("o_orderdate") + F.make_dt_interval(secs=(F.col("o_orderkey") % 86400).cast("int"))
    return o.select(
        F.col("o_orderkey").alias("log_id"), job.alias("job"), start.alias("started_at"),
        (start + F.make_dt_interval(secs=(F.col("o_orderkey") % 600).cast("int"))).alias("ended_at"),
        F.when(F.col("o_orderstatus") == "P", "FAILED").otherwise("SUCCESS").alias("status"),
        F.floor("o_totalprice").alias("n_rows"), F.col("o_orderpriority").alias("note"))


# ---------------------------------------------------------------- DuckDB twins

_IG = _case_sql("p_type", INDEX_GROUPS, "Other")
_AGE = "CASE WHEN {k} % 11 = 0 THEN NULL ELSE 18 + {k} % 60 END"
_TRAFFIC = "CASE " + " ".join(f"WHEN uid % 7 = {i} THEN '{n}'" for i, n in enumerate(TRAFFIC)) + " END"

SQL: dict[str, str] = {
    "transactions": """
SELECT CAST(o.o_orderdate AS DATE) AS t_dat, o.o_custkey AS customer_id, l.l_partkey AS article_id,
       l.l_extendedprice AS price, CASE WHEN l.l_linestatus = 'O' THEN 2 ELSE 1 END AS sales_channel_id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "articles": f"""
SELECT p_partkey AS article_id, p_name AS prod_name, p_type AS product_type_name,
       p_brand AS product_group_name, {_IG} AS index_group_name,
       CASE WHEN p_size <= 25 THEN 'Men' ELSE 'Women' END AS department_name
FROM part""",
    "fashion_customers": f"""
SELECT c_custkey AS customer_id, {_AGE.format(k='c_custkey')} AS age,
       CASE WHEN c_mktsegment IN ('AUTOMOBILE','BUILDING','HOUSEHOLD') THEN 'ACTIVE'
            WHEN c_mktsegment = 'FURNITURE' THEN 'PRE-CREATE' ELSE 'LEFT CLUB' END AS club_member_status,
       CASE WHEN c_custkey % 3 = 0 THEN 'Regularly' ELSE 'NONE' END AS fashion_news_frequency,
       'P' || CAST(c_nationkey AS VARCHAR) AS postal_code
FROM customer""",
    "users": f"""
SELECT c.c_custkey AS id, {_AGE.format(k='c.c_custkey')} AS age,
       CASE WHEN c.c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
       n.n_name AS country, c.c_mktsegment AS traffic_source
FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "products": """
SELECT p_partkey AS id, p_name AS name, p_brand AS category,
       CASE WHEN p_size <= 25 THEN 'Men' ELSE 'Women' END AS department, p_brand AS brand,
       p_retailprice AS retail_price, p_retailprice * (0.375 + 0.0625 * (p_partkey % 5)) AS cost,
       p_partkey % 10 + 1 AS distribution_center_id
FROM part""",
    "order_items": """
SELECT l.l_orderkey AS order_id, o.o_custkey AS user_id, l.l_partkey AS product_id, l.l_linenumber AS line_no,
       l.l_extendedprice / l.l_quantity AS sale_price,
       CASE WHEN l.l_returnflag = 'R' THEN 'Returned' WHEN o.o_orderstatus = 'P' THEN 'Cancelled'
            WHEN o.o_orderstatus = 'F' THEN 'Complete' ELSE 'Shipped' END AS status,
       o.o_orderdate AS created_at, l.l_shipdate AS shipped_at,
       l.l_shipdate + to_days(CAST(l.l_linenumber AS INTEGER)) AS delivered_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "shop_orders": """
SELECT o.o_orderkey AS order_id, o.o_custkey AS user_id, o.o_orderdate AS created_at,
       COALESCE(c.n, 0) AS num_of_item
FROM orders o LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c
  ON c.l_orderkey = o.o_orderkey""",
    "inventory_items": """
SELECT l.l_partkey AS product_id, o.o_orderdate AS created_at, l.l_shipdate AS sold_at
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "shop_events": f"""
SELECT event_id, CASE WHEN uid % 5 = 0 THEN NULL ELSE uid END AS user_id, uid AS visitor_id,
       CAST(uid AS VARCHAR) || '-' || CAST(epoch_us(session_start) AS VARCHAR) AS session_id,
       CAST(ROW_NUMBER() OVER (PARTITION BY uid, session_start ORDER BY ts, event_id) AS INTEGER) AS sequence_number,
       {_case_sql('raw_type', EVENT_TYPES)} AS event_type,
       CASE raw_type WHEN 'view' THEN '/product/' || CAST(k AS VARCHAR)
            WHEN 'signup' THEN '/department/' || CASE WHEN k % 2 = 0 THEN 'Men' ELSE 'Women' END
                               || '/category/Brand#' || CAST(k % 25 + 1 AS VARCHAR)
            WHEN 'click' THEN '/cart' WHEN 'purchase' THEN '/purchase' ELSE '/cancel' END AS uri,
       {_TRAFFIC} AS traffic_source, ts AS created_at
FROM (
  SELECT *, MAX(CASE WHEN is_start THEN ts END) OVER (PARTITION BY uid ORDER BY ts, event_id
                                                     ROWS UNBOUNDED PRECEDING) AS session_start
  FROM (
    SELECT *, (prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) > {SESSION_GAP_US}) AS is_start
    FROM (
      SELECT event_id, ts, user_id AS uid, event_type AS raw_type,
             CAST(NULLIF(regexp_extract(props, '"k": *([0-9]+)', 1), '') AS BIGINT) AS k,
             LAG(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_ts
      FROM events) a) b) c""",
}

_JOB = "CASE " + " ".join(f"WHEN o_orderkey % {len(LOG_JOBS)} = {i} THEN '{n}'" for i, n in enumerate(LOG_JOBS)) + " END"
SQL["etl_log"] = f"""
SELECT o_orderkey AS log_id, {_JOB} AS job,
       o_orderdate + to_seconds(CAST(o_orderkey % 86400 AS BIGINT)) AS started_at,
       o_orderdate + to_seconds(CAST(o_orderkey % 86400 + o_orderkey % 600 AS BIGINT)) AS ended_at,
       CASE WHEN o_orderstatus = 'P' THEN 'FAILED' ELSE 'SUCCESS' END AS status,
       CAST(FLOOR(o_totalprice) AS BIGINT) AS n_rows, o_orderpriority AS note
FROM orders"""

DEPS: dict[str, tuple[str, ...]] = {}
