"""Adapters that shape the driver's TPC-H-like tables as the library's inputs.

``impressions`` is a grouped binary-outcome table (one row per line item, grouped
by order) with the 22 audited columns plus ``row_id``.  The ``pred_*`` frames
are prediction tables ``(row_id, grp, y, p)``.  Every adapter has a DuckDB SQL
twin used by the oracle queries; both are written side by side so they stay in
step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ranklift.functions.scalars import rnd
from ranklift.session import read_table

#: Canonical column order of the impressions table.
IMPRESSION_COLUMNS = (
    "title", "description", "price", "category", "timestamp", "query_id", "filter_category",
    "filter_price_min", "filter_price_max", "filter_storage_type", "cart", "bought", "brand",
    "package_size", "unit_of_measure", "net_weight_oz", "dimensions_in", "storage_type",
    "ingredients", "allergens", "nutrition_score", "country_of_origin",
)

NO_PRIORITY = "4-NOT SPECIFIED"
#: Suppliers that every task may hold.
SUPPLIERS_BROADCAST = 500_000


def _tenths(c):
    """Integer tenths rendered as text: 33 -> '3.3'."""
    return F.concat(F.floor(c / 10).cast("bigint").cast("string"), F.lit("."), (c % 10).cast("string"))


def lineitem_row_id() -> F.Column:
    return F.md5(F.concat_ws(
        "|", *[F.col(c).cast("string") for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")],
        F.col("l_quantity").cast("bigint").cast("string"), F.col("l_returnflag"), F.col("l_linestatus"),
        F.date_format("l_shipdate", "yyyy-MM-dd")))


def impressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined with part, orders, supplier and nation.

    Join strategy is left to Catalyst/AQE: part and orders grow with
    the scale factor, so they are never force-broadcast; AQE turns a join into
    a broadcast at run time only when the measured side is under the threshold.
    ``nation`` has a fixed 25 rows, so it is broadcast explicitly; supplier, with two narrow
    columns, while a count says that it is small: that saves one shuffle of all line items.
    """
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
        "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    li = li.withColumn("price", rnd(F.col("l_extendedprice") / F.col("l_quantity"), 2))
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size")
    orders = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    supplier = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    nation = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")

    # per-order price window; partial aggregation before the shuffle
    order_range = (li.groupBy("l_orderkey")
                   .agg(F.floor(F.min("price")).cast("double").alias("filter_price_min"),
                        F.ceil(F.max("price")).cast("double").alias("filter_price_max")))
    order_ctx = order_range.join(orders, order_range.l_orderkey == orders.o_orderkey).drop("o_orderkey")
    supp = supplier.join(F.broadcast(nation), supplier.s_nationkey == nation.n_nationkey).select("s_suppkey", "n_name")
    if supplier.count() <= SUPPLIERS_BROADCAST:
        supp = F.broadcast(supp)

    j = (li.join(order_ctx, "l_orderkey")
         .join(part, li.l_partkey == part.p_partkey)
         .join(supp, li.l_suppkey == supp.s_suppkey))

    size_txt = F.col("p_size").cast("string")
    marker = F.when(F.col("p_type") == "SMALL", F.lit("")).otherwise(F.concat(F.lit(" ("), F.col("p_type"), F.lit(")")))
    title = F.concat(F.col("p_brand"), F.lit(" "), F.col("p_name"), F.lit(" - "), size_txt, F.lit(" oz"), marker)
    tail = F.when(F.col("o_orderpriority") == NO_PRIORITY, F.lit("")).otherwise(
        F.concat(F.lit(" Priority "), F.lower("o_orderpriority"), F.lit(" across the region.")))
    description = F.concat(F.col("p_name"), F.lit(" in a "), size_txt, F.lit(" oz package for online orders. Listed under "),
                           F.lower("p_type"), F.lit(" and intended for "), F.lower("l_linestatus"),
                           F.lit(" storage."), tail)
    words = F.split("p_name", " ")
    ingredients = F.when(F.col("l_linenumber") % 2 == 0, F.array_join(words, ", ")).otherwise(
        F.array_join(F.reverse(words), ", "))
    dims = F.concat(_tenths(F.col("p_size")), F.lit(" x "), _tenths(F.col("p_size") + 5), F.lit(" x "),
                    _tenths(F.col("p_size") * 2 + 3), F.lit('"'))
    return j.select(
        lineitem_row_id().alias("row_id"),
        title.alias("title"),
        description.alias("description"),
        F.col("price"),
        F.col("p_type").alias("category"),
        F.col("l_shipdate").alias("timestamp"),
        F.col("l_orderkey").cast("string").alias("query_id"),
        F.col("p_type").alias("filter_category"),
        "filter_price_min", "filter_price_max",
        F.col("l_linestatus").alias("filter_storage_type"),
        F.col("l_returnflag").isin("R", "A").alias("cart"),
        (F.col("l_returnflag") == "R").alias("bought"),
        F.col("p_brand").alias("brand"),
        F.concat(size_txt, F.lit(" oz")).alias("package_size"),
        F.lit("oz").alias("unit_of_measure"),
        F.col("p_size").cast("double").alias("net_weight_oz"),
        dims.alias("dimensions_in"),
        F.col("l_linestatus").alias("storage_type"),
        ingredients.alias("ingredients"),
        F.when(F.col("o_orderpriority") != NO_PRIORITY, F.col("o_orderpriority")).alias("allergens"),
        (F.col("l_discount") * 100).alias("nutrition_score"),
        F.col("n_name").alias("country_of_origin"),
    )


IMPRESSIONS_SQL = """
_li AS (
  SELECT *, floor(l_extendedprice / l_quantity * 100.0 + 0.5) / 100.0 AS price FROM lineitem
), _rng AS (
  SELECT l_orderkey AS rk, CAST(floor(min(price)) AS DOUBLE) AS filter_price_min,
         CAST(ceil(max(price)) AS DOUBLE) AS filter_price_max
  FROM _li GROUP BY l_orderkey
), impressions AS (
  SELECT
    md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR),
        CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR), l_returnflag, l_linestatus,
        strftime(l_shipdate, '%Y-%m-%d'))) AS row_id,
    p_brand || ' ' || p_name || ' - ' || CAST(p_size AS VARCHAR) || ' oz'
      || CASE WHEN p_type = 'SMALL' THEN '' ELSE ' (' || p_type || ')' END AS title,
    p_name || ' in a ' || CAST(p_size AS VARCHAR) || ' oz package for online orders. Listed under '
      || lower(p_type) || ' and intended for ' || lower(l_linestatus) || ' storage.'
      || CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN ''
              ELSE ' Priority ' || lower(o_orderpriority) || ' across the region.' END AS description,
    price,
    p_type AS category,
    l_shipdate AS "timestamp",
    CAST(l_orderkey AS VARCHAR) AS query_id,
    p_type AS filter_category,
    filter_price_min, filter_price_max,
    l_linestatus AS filter_storage_type,
    l_returnflag IN ('R', 'A') AS cart,
    l_returnflag = 'R' AS bought,
    p_brand AS brand,
    CAST(p_size AS VARCHAR) || ' oz' AS package_size,
    'oz' AS unit_of_measure,
    CAST(p_size AS DOUBLE) AS net_weight_oz,
    CAST(p_size // 10 AS VARCHAR) || '.' || CAST(p_size % 10 AS VARCHAR) || ' x '
      || CAST((p_size + 5) // 10 AS VARCHAR) || '.' || CAST((p_size + 5) % 10 AS VARCHAR) || ' x '
      || CAST((p_size * 2 + 3) // 10 AS VARCHAR) || '.' || CAST((p_size * 2 + 3) % 10 AS VARCHAR) || '"' AS dimensions_in,
    l_linestatus AS storage_type,
    CASE WHEN l_linenumber % 2 = 0 THEN array_to_string(string_split(p_name, ' '), ', ')
         ELSE array_to_string(list_reverse(string_split(p_name, ' ')), ', ') END AS ingredients,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS allergens,
    l_discount * 100 AS nutrition_score,
    n_name AS country_of_origin
  FROM _li
  JOIN _rng ON l_orderkey = rk
  JOIN orders ON l_orderkey = o_orderkey
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
)"""


# ---------------------------------------------------------------------------
# prediction fixtures (row_id, grp, y, p)
# ---------------------------------------------------------------------------

def pred_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("string").alias("row_id"),
        F.col("user_id").cast("string").alias("grp"),
        (F.col("event_type") == "purchase").cast("int").alias("y"),
        F.least(rnd(F.col("value") / 500.0, 2), F.lit(1.0)).alias("p"),
    )


def pred_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        lineitem_row_id().alias("row_id"),
        F.col("l_orderkey").cast("string").alias("grp"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
        F.col("l_discount").alias("p"),
    )


def pred_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    j = docs.join(labels, "doc_id")
    top = j.select(F.max("n_chars").cast("double")).scalar()
    return j.select(
        F.col("doc_id").cast("string").alias("row_id"),
        F.col("source").alias("grp"),
        F.col("quality").cast("int").alias("y"),
        (F.col("n_chars") / top).alias("p"),
    )


PRED_SQL = {
    "ev": """SELECT CAST(event_id AS VARCHAR) AS row_id, CAST(user_id AS VARCHAR) AS grp,
                    CAST(event_type = 'purchase' AS INTEGER) AS y,
                    least(floor(value / 500.0 * 100.0 + 0.5) / 100.0, 1.0) AS p FROM events""",
    "li": """SELECT md5(concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_partkey AS VARCHAR),
                    CAST(l_suppkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(CAST(l_quantity AS BIGINT) AS VARCHAR),
                    l_returnflag, l_linestatus, strftime(l_shipdate, '%Y-%m-%d'))) AS row_id,
                    CAST(l_orderkey AS VARCHAR) AS grp, CAST(l_returnflag = 'R' AS INTEGER) AS y,
                    l_discount AS p FROM lineitem""",
    "doc": """SELECT CAST(d.doc_id AS VARCHAR) AS row_id, d.source AS grp, CAST(l.quality AS INTEGER) AS y,
                     CAST(d.n_chars AS DOUBLE) / (SELECT max(d2.n_chars) FROM documents d2 JOIN labels l2 ON d2.doc_id = l2.doc_id) AS p
              FROM documents d JOIN labels l ON d.doc_id = l.doc_id""",
}

PRED_FIXTURES = {"ev": pred_events, "li": pred_lineitem, "doc": pred_documents}


def with_sql(body: str, *ctes: str) -> str:
    """Prefix a SELECT with the named CTE blocks (``impressions``, ``pred_ev`` ...)."""
    parts = []
    for c in ctes:
        if c == "impressions":
            parts.append(IMPRESSIONS_SQL.strip())
        elif c.startswith("pred_"):
            parts.append(f"{c} AS ({PRED_SQL[c[5:]]})")
        else:
            parts.append(c)
    body = body.strip()
    if not parts:
        return body
    # a body that starts with ',' continues the CTE list with its own blocks
    return "WITH " + ",\n".join(parts) + ("\n" if body.startswith(",") else "\n") + body
