"""Registered registry / serving / ingest / sink queries."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from shopframe.catalog.base import register
from shopframe.catalog.rules import CLUSTERS_CTE, FASH, GROUPS, clusters
from shopframe.functions.exprs import rnd, rnd_sql as R
from shopframe.operators import features as f
from shopframe.operators import ingest as ing
from shopframe.operators import registry as reg
from shopframe.session import checkpoint_dir
from shopframe.plans.oracle import with_views as W
from shopframe.sources import sinks

LABELS_SQL = "CASE cluster_id " + " ".join(f"WHEN {i} THEN '{g}'" for i, g in enumerate(GROUPS)) + " END"


def V(t, name):
    return t.view(name)


def labelled(t):
    lab = None
    for i, g in enumerate(GROUPS):
        lab = F.when(F.col("cluster_id") == i, g) if lab is None else lab.when(F.col("cluster_id") == i, g)
    return clusters(t).withColumn("cluster_label", lab)


LCL = ("lcl", f"SELECT customer_id, cluster_id, {LABELS_SQL} AS cluster_label FROM clusters")

register("serve_cluster_distribution", W(FASH, """
SELECT cluster_id, cluster_label, COUNT(*) AS n FROM lcl GROUP BY 1, 2""", [CLUSTERS_CTE, LCL]))(
    lambda t: reg.cluster_distribution(labelled(t)))

register("serve_customers_in_cluster", W(FASH, f"""
SELECT p.customer_id, p.cluster_id, p.cluster_label, c.age, c.club_member_status,
       COALESCE(s.n_tx, 0) AS n_transactions, {R('COALESCE(s.spent, 0.0)', 4)} AS total_spent, s.last_purchase,
       (SELECT COUNT(*) FROM lcl WHERE cluster_id = 0) AS total,
       CAST(CEIL((SELECT COUNT(*) FROM lcl WHERE cluster_id = 0) / 10.0) AS BIGINT) AS total_pages
FROM (SELECT * FROM lcl WHERE cluster_id = 0 ORDER BY customer_id LIMIT 10 OFFSET 10) p
LEFT JOIN fashion_customers c ON c.customer_id = p.customer_id
LEFT JOIN (SELECT customer_id, COUNT(*) AS n_tx, SUM(price) AS spent, MAX(t_dat) AS last_purchase
           FROM transactions GROUP BY 1) s ON s.customer_id = p.customer_id""", [CLUSTERS_CTE, LCL]))(
    lambda t: reg.customers_in_cluster(labelled(t), V(t, "fashion_customers"), V(t, "transactions"), 0, page=2, size=10)
    .withColumn("total_pages", F.col("total_pages").cast("long")))

register("serve_customer_profiles", W(FASH, f"""
SELECT c.customer_id, c.age, c.club_member_status, c.fashion_news_frequency, c.postal_code, s.n_transactions,
       s.n_days_active, {R('s.total_spent', 6)} AS total_spent, {R('s.avg_price', 6)} AS avg_price, s.first_purchase,
       s.last_purchase, {R('s.pct_online', 6)} AS pct_online, g.top_key AS top_product_groups, l.cluster_id,
       l.cluster_label
FROM fashion_customers c
LEFT JOIN (SELECT customer_id, COUNT(*) AS n_transactions, COUNT(DISTINCT t_dat) AS n_days_active,
                  SUM(price) AS total_spent, AVG(price) AS avg_price, MIN(t_dat) AS first_purchase,
                  MAX(t_dat) AS last_purchase, AVG(CASE WHEN sales_channel_id = 2 THEN 1.0 ELSE 0.0 END) AS pct_online
           FROM transactions GROUP BY 1) s ON c.customer_id = s.customer_id
LEFT JOIN (SELECT customer_id, string_agg(product_group_name || ':' || CAST(n AS VARCHAR), '|' ORDER BY r) AS top_key
           FROM (SELECT customer_id, product_group_name, n,
                        ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY n DESC, product_group_name) AS r
                 FROM (SELECT t.customer_id, a.product_group_name, COUNT(*) AS n FROM transactions t
                       JOIN articles a ON t.article_id = a.article_id GROUP BY 1, 2) x) y WHERE r <= 5 GROUP BY 1) g
  ON c.customer_id = g.customer_id
LEFT JOIN lcl l ON c.customer_id = l.customer_id""", [CLUSTERS_CTE, LCL]))(
    lambda t: reg.customer_profiles(V(t, "fashion_customers"), V(t, "transactions"), V(t, "articles"), labelled(t))
    .select("customer_id", "age", "club_member_status", "fashion_news_frequency", "postal_code", "n_transactions",
            "n_days_active", rnd("total_spent", 6).alias("total_spent"), rnd("avg_price", 6).alias("avg_price"),
            "first_purchase", "last_purchase", rnd("pct_online", 6).alias("pct_online"),
            F.array_join(F.transform("top_product_groups", lambda x: F.concat(
                x["group_name"], F.lit(":"), x["n"].cast("string"))), "|").alias("top_product_groups"),
            "cluster_id", "cluster_label"))

register("serve_mining_summary", W(FASH, """
SELECT (SELECT COUNT(*) FROM fashion_customers) AS n_customers, (SELECT COUNT(*) FROM articles) AS n_articles,
       (SELECT COUNT(*) FROM transactions) AS n_transactions, (SELECT MAX(t_dat) FROM transactions)
         AS latest_transaction_date, (SELECT COUNT(*) FROM clusters) AS n_clustered_customers""", [CLUSTERS_CTE]))(
    lambda t: reg.mining_summary(V(t, "fashion_customers"), V(t, "articles"), V(t, "transactions"), clusters(t)))

# a rule model (online share above one half) logged at the 7-day cutoff, then resolved
_CUT = "(SELECT MAX(t_dat) - 7 FROM transactions)"


def _rule_predictions(t):
    tx = V(t, "transactions")
    cut = tx.agg(F.date_sub(F.max("t_dat"), 7).alias("cutoff"))
    feats = f.customer_features(tx, V(t, "articles"), V(t, "fashion_customers"), cut)
    pred = feats.select("customer_id", (F.col("pct_online") > 0.5).cast("int").alias("will_buy"))
    at = cut.first()["cutoff"]  # one scalar: the log's timestamp
    return reg.prediction_rows(pred, "L3_RANDOMFOREST", "rule-online-v1", ["will_buy"], at)


_PRED_SQL = f"""SELECT customer_id, 'L3_RANDOMFOREST' AS layer, 'rule-online-v1' AS model_version,
  '{{"will_buy":' || CAST(CASE WHEN pct_online > 0.5 THEN 1 ELSE 0 END AS VARCHAR) || '}}' AS predicted_value,
  CAST(NULL AS VARCHAR) AS actual_value, CAST({_CUT} AS TIMESTAMP) AS predicted_at, CAST(NULL AS TIMESTAMP) AS resolved_at
FROM (SELECT t.customer_id, AVG(CASE WHEN t.sales_channel_id = 2 THEN 1.0 ELSE 0.0 END) AS pct_online
      FROM transactions t JOIN articles a ON t.article_id = a.article_id WHERE t.t_dat <= {_CUT} GROUP BY 1) x"""
register("serve_prediction_log_rows", W(FASH, _PRED_SQL))(_rule_predictions)

register("serve_resolved_accuracy", W(FASH, f"""
SELECT model_version, COUNT(*) AS n_resolved, {R('AVG(CAST(correct AS DOUBLE))', 9)} AS accuracy FROM (
  SELECT p.model_version, CAST(json_extract_string(p.predicted_value, '$.will_buy') AS INTEGER) =
         CASE WHEN EXISTS (SELECT 1 FROM transactions t WHERE t.customer_id = p.customer_id
                           AND t.t_dat > CAST(p.predicted_at AS DATE) AND t.t_dat <= CAST(p.predicted_at AS DATE) + 7)
              THEN 1 ELSE 0 END AS correct
  FROM ({_PRED_SQL}) p) z GROUP BY 1""".replace(
    "CAST(json_extract_string(p.predicted_value, '$.will_buy') AS INTEGER)",
    "CAST(regexp_extract(p.predicted_value, '\"will_buy\":([0-9]+)', 1) AS INTEGER)")))(
    lambda t: reg.accuracy_by_version(reg.resolve_predictions(_rule_predictions(t), V(t, "transactions")))
    .withColumn("accuracy", rnd("accuracy", 9)))

# ---------------------------------------------------------------- ingest


def _last_day_batch(t):
    """Transactions of the newest day in ingest form; the online lines carry an article id outside
    the catalogue, so the report has unknown articles."""
    tx = V(t, "transactions")
    last = tx.agg(F.max("t_dat").alias("_d"))
    b = tx.join(last, tx.t_dat == last._d).drop("_d")
    aid = F.when(F.col("sales_channel_id") == 2, F.col("article_id") + 100000000).otherwise(F.col("article_id"))
    return b.select("t_dat", "customer_id", aid.cast("string").alias("article_id"), "price", "sales_channel_id")


_B = ("b", """SELECT t_dat, customer_id, CAST(CASE WHEN sales_channel_id = 2 THEN article_id + 100000000
  ELSE article_id END AS VARCHAR) AS article_id, price, sales_channel_id FROM transactions
  WHERE t_dat = (SELECT MAX(t_dat) FROM transactions)""")
_MC = ("mc", "SELECT DISTINCT customer_id FROM b WHERE customer_id NOT IN (SELECT customer_id FROM fashion_customers)")
_MA = ("ma", """SELECT DISTINCT TRY_CAST(article_id AS BIGINT) AS article_id FROM b
  WHERE TRY_CAST(article_id AS BIGINT) IS NOT NULL AND TRY_CAST(article_id AS BIGINT) NOT IN (SELECT article_id FROM articles)""")
register("ingest_validate_batch", W(FASH, """
SELECT n_rows, bad_article_ids, bad_channels, n_missing_customers, n_missing_articles,
       COALESCE(array_to_string(missing_customers, '|'), '') AS missing_customers,
       COALESCE(array_to_string(missing_articles, '|'), '') AS missing_articles,
       n_rows > 10000 AS too_many,
       n_rows > 0 AND n_rows <= 10000 AND bad_article_ids = 0 AND bad_channels = 0 AND n_missing_customers = 0
         AND n_missing_articles = 0 AS ok
FROM (SELECT (SELECT COUNT(*) FROM b) AS n_rows,
             (SELECT COUNT(*) FROM b WHERE TRY_CAST(article_id AS BIGINT) IS NULL) AS bad_article_ids,
             (SELECT COUNT(*) FROM b WHERE sales_channel_id NOT IN (1, 2) OR sales_channel_id IS NULL) AS bad_channels,
             (SELECT COUNT(*) FROM mc) AS n_missing_customers, (SELECT COUNT(*) FROM ma) AS n_missing_articles,
             (SELECT list_sort(list(customer_id)) FROM (SELECT customer_id FROM mc ORDER BY 1 LIMIT 20) x) AS missing_customers,
             (SELECT list_sort(list(article_id)) FROM (SELECT article_id FROM ma ORDER BY 1 LIMIT 20) y) AS missing_articles) z""",
    [_B, _MC, _MA]))(
    lambda t: ing.validate_transactions(_last_day_batch(t), V(t, "fashion_customers"), V(t, "articles"), ing.MAX_REQUEST_ROWS)
    .select("n_rows", "bad_article_ids", "bad_channels", "n_missing_customers", "n_missing_articles",
            F.array_join(F.col("missing_customers").cast("array<string>"), "|").alias("missing_customers"),
            F.array_join(F.col("missing_articles").cast("array<string>"), "|").alias("missing_articles"),
            "too_many", "ok"))


def _active_on(t, which):
    """Customers with a purchase on the newest (or first) day of the transactions."""
    tx = V(t, "transactions")
    d = tx.agg((F.max("t_dat") if which == "last" else F.min("t_dat")).alias("_d"))
    return tx.join(d, tx.t_dat == d._d).select("customer_id").distinct()


def _updates(t):
    """An update batch derived from activity: customers active on the newest day get age + 1 and a
    monthly newsletter (other fields null = unchanged); customers active on the first day come back
    as new sign-ups under a new id."""
    c = V(t, "fashion_customers")
    upd = c.join(_active_on(t, "last"), "customer_id", "left_semi").select(
        "customer_id", (F.col("age") + 1).alias("age"), F.lit(None).cast("string").alias("club_member_status"),
        F.lit("Monthly").alias("fashion_news_frequency"), F.lit(None).cast("string").alias("postal_code"))
    new = c.join(_active_on(t, "first"), "customer_id", "left_semi").select(
        (F.col("customer_id") + 1000000000).alias("customer_id"), "age", "club_member_status",
        "fashion_news_frequency", "postal_code")
    return upd.unionByName(new)


_ACT_LAST = ("act_last", "SELECT DISTINCT customer_id FROM transactions WHERE t_dat = (SELECT MAX(t_dat) FROM transactions)")
_ACT_FIRST = ("act_first", "SELECT DISTINCT customer_id FROM transactions WHERE t_dat = (SELECT MIN(t_dat) FROM transactions)")
_U = ("u", """SELECT customer_id, age + 1 AS age, CAST(NULL AS VARCHAR) AS club_member_status,
  'Monthly' AS fashion_news_frequency, CAST(NULL AS VARCHAR) AS postal_code FROM fashion_customers
  WHERE customer_id IN (SELECT customer_id FROM act_last)
  UNION ALL SELECT customer_id + 1000000000, age, club_member_status, fashion_news_frequency, postal_code
  FROM fashion_customers WHERE customer_id IN (SELECT customer_id FROM act_first)""")
register("ingest_upsert_customers", W(FASH, """
SELECT COALESCE(t.customer_id, u.customer_id) AS customer_id, COALESCE(u.age, t.age) AS age,
       COALESCE(u.club_member_status, t.club_member_status) AS club_member_status,
       COALESCE(u.fashion_news_frequency, t.fashion_news_frequency) AS fashion_news_frequency,
       COALESCE(u.postal_code, t.postal_code) AS postal_code
FROM fashion_customers t FULL OUTER JOIN u ON t.customer_id = u.customer_id""", [_ACT_LAST, _ACT_FIRST, _U]))(
    lambda t: ing.upsert_customers(V(t, "fashion_customers"), _updates(t)))

register("sink_upsert_customers", W(FASH, """
SELECT * FROM fashion_customers WHERE customer_id NOT IN (SELECT customer_id FROM u)
UNION ALL SELECT * FROM u""", [_ACT_LAST, _ACT_FIRST, _U]))(
    lambda t: sinks.upsert(V(t, "fashion_customers"), _updates(t), "customer_id"))

# three versions of every fourth customer in one batch: the last by revision wins, "fill" keeps what is not null
_REV = ("rev", """SELECT c.customer_id, CASE WHEN r = 2 THEN NULL ELSE age + r END AS age, 'rev ' || r AS club_member_status,
  CASE WHEN r = 1 THEN 'Weekly' END AS fashion_news_frequency, CAST(NULL AS VARCHAR) AS postal_code, r AS revision
  FROM fashion_customers c, (VALUES (0), (1), (2)) x(r) WHERE customer_id % 4 = 0""")


def _revisions(t):
    r = F.col("revision")
    return V(t, "fashion_customers").filter("customer_id % 4 = 0").withColumn("revision", F.explode(F.array(*[F.lit(i) for i in range(3)]))).select(
        "customer_id", F.when(r != 2, F.col("age") + r).alias("age"), F.concat(F.lit("rev "), r.cast("string")).alias("club_member_status"),
        F.when(r == 1, F.lit("Weekly")).alias("fashion_news_frequency"), F.lit(None).cast("string").alias("postal_code"), "revision")


def _keyed(t, mode):
    """The customers in 64 buckets, updated twice: by the revisions, then by the activity of the newest day."""
    from shopframe.sources.keyed import KeyedTable
    c = V(t, "fashion_customers")
    table = KeyedTable.create(c, f"{checkpoint_dir(t.spark)}/keyed-{uuid.uuid4().hex}", "customer_id", 64)
    table.upsert(_revisions(t), ["revision"], mode)
    table.upsert(_updates(t), mode=mode)
    return table.read()


register("sink_keyed_replace", W(FASH, """
SELECT * FROM u UNION ALL
SELECT customer_id, age, club_member_status, fashion_news_frequency, postal_code FROM rev WHERE revision = 2 AND customer_id NOT IN (SELECT customer_id FROM u)
UNION ALL SELECT * FROM fashion_customers WHERE customer_id % 4 <> 0 AND customer_id NOT IN (SELECT customer_id FROM u)""",
                               [_ACT_LAST, _ACT_FIRST, _U, _REV]))(lambda t: _keyed(t, "replace"))

register("ingest_keyed_fill", W(FASH, """
SELECT COALESCE(t.customer_id, u.customer_id) AS customer_id, COALESCE(u.age, r1.age, t.age) AS age,
       COALESCE(u.club_member_status, r2.club_member_status, t.club_member_status) AS club_member_status,
       COALESCE(u.fashion_news_frequency, r1.fashion_news_frequency, t.fashion_news_frequency) AS fashion_news_frequency,
       COALESCE(u.postal_code, t.postal_code) AS postal_code
FROM fashion_customers t LEFT JOIN rev r1 ON r1.customer_id = t.customer_id AND r1.revision = 1
LEFT JOIN rev r2 ON r2.customer_id = t.customer_id AND r2.revision = 2 FULL OUTER JOIN u ON t.customer_id = u.customer_id""",
                              [_ACT_LAST, _ACT_FIRST, _U, _REV]))(lambda t: _keyed(t, "fill"))

register("sink_insert_statements", """
SELECT CAST(FLOOR((rn - 1) / 100) AS BIGINT) AS batch_id,
       'INSERT INTO customer (c_custkey, c_name, c_mktsegment) VALUES' || chr(10) ||
       string_agg('(' || CAST(c_custkey AS VARCHAR) || ', ' || COALESCE('''' || replace(c_name, '''', '''''') || '''', 'NULL')
                  || ', ' || COALESCE('''' || replace(c_mktsegment, '''', '''''') || '''', 'NULL') || ')', ',' || chr(10)
                  ORDER BY rn) || ';' AS statement
FROM (SELECT *, ROW_NUMBER() OVER (ORDER BY c_custkey, c_name, c_mktsegment) AS rn FROM customer) x GROUP BY 1""")(
    lambda t: sinks.insert_statements(t["customer"].select("c_custkey", "c_name", "c_mktsegment"), "customer", 100))


@register("ingest_stream_replay", W(FASH, """
SELECT t_dat, customer_id, CAST(article_id AS VARCHAR) AS article_id, price,
       CAST(sales_channel_id AS INTEGER) AS sales_channel_id, CAST(0 AS BIGINT) AS batch_epoch
FROM transactions WHERE t_dat = (SELECT MAX(t_dat) FROM transactions)"""))
def _stream(t):
    """I4 end to end: the newest day's transactions are dropped as files; the stream validates and
    appends them; the appended rows are returned."""
    from shopframe.streaming.ingest_stream import stream_transactions
    base = f"{checkpoint_dir(t.spark)}/ingest-{uuid.uuid4().hex}"
    tx = V(t, "transactions")
    last = tx.agg(F.max("t_dat").alias("_d"))
    good = tx.join(last, tx.t_dat == last._d).drop("_d").select(
        "t_dat", "customer_id", F.col("article_id").cast("string").alias("article_id"), "price",
        F.col("sales_channel_id").cast("int").alias("sales_channel_id"))
    good.write.parquet(f"{base}/in/batch1")
    q = stream_transactions(t.spark, f"{base}/in/batch1", f"{base}/out", f"{base}/bad", V(t, "fashion_customers"),
                            V(t, "articles"), name=f"ingest_{uuid.uuid4().hex[:8]}")
    q.awaitTermination()
    out = t.spark.read.parquet(f"{base}/out")
    return out.drop("batch_id")


@register("ingest_stream_files", W(FASH, """
SELECT t_dat, customer_id, CAST(article_id AS VARCHAR) AS article_id, price, CAST(sales_channel_id AS INTEGER) AS sales_channel_id
FROM transactions WHERE t_dat NOT IN (SELECT t_dat FROM transactions GROUP BY t_dat HAVING MAX(customer_id) % 7 = 0)"""))
def _stream_files(t):
    """I4 over all transactions: a file per group of days; days whose greatest customer is divisible
    by 7 come in files of their own with an unknown customer, and are quarantined without touching the rest."""
    from shopframe.streaming.ingest_stream import stream_transactions
    base = f"{checkpoint_dir(t.spark)}/ingest-{uuid.uuid4().hex}"
    tx = V(t, "transactions").select("t_dat", "customer_id", F.col("article_id").cast("string").alias("article_id"), "price",
                                     F.col("sales_channel_id").cast("int").alias("sales_channel_id"))
    spoilt = tx.groupBy("t_dat").agg(F.max("customer_id").alias("_m")).where("_m % 7 = 0").select("t_dat")
    bad = tx.join(spoilt, "t_dat", "left_semi")
    bad = bad.withColumn("customer_id", -F.col("customer_id"))
    good = tx.join(spoilt, "t_dat", "left_anti")
    good.repartition(9, F.weekofyear("t_dat")).write.parquet(f"{base}/in/good")
    bad.repartition(1).write.parquet(f"{base}/in/bad")
    q = stream_transactions(t.spark, f"{base}/in/*", f"{base}/out", f"{base}/bad", V(t, "fashion_customers"),
                            V(t, "articles"), name=f"ingest_{uuid.uuid4().hex[:8]}")
    q.awaitTermination()
    return t.spark.read.parquet(f"{base}/out").drop("batch_id", "batch_epoch")


# ---------------------------------------------------------------- S2: SQL text with bind parameters

@register("source_sql_bind", """
SELECT o_orderstatus, COUNT(*) AS n_orders, CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(28, 6))), 2) AS DOUBLE) AS total
FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01' GROUP BY o_orderstatus""")
def _s2(t):
    from shopframe.sources.tables import sql_source
    name = f"orders_{uuid.uuid4().hex[:8]}"
    return sql_source(t.spark, f"""
        SELECT o_orderstatus, COUNT(*) AS n_orders, CAST(ROUND(SUM(CAST(o_totalprice AS DECIMAL(28, 6))), 2) AS DOUBLE) AS total
        FROM {name} WHERE o_orderdate >= CAST(:since AS TIMESTAMP_NTZ) GROUP BY o_orderstatus""",
                      {"since": "1998-01-01 00:00:00"}, {name: t["orders"]})
