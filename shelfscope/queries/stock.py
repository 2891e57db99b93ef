"""Registered queries over stock movements (R13) and successive snapshots.

Even lines stand for purchase orders: ordered when their order is placed, received when shipped.  Odd lines stand for
customer orders, sold when their order is placed.  Snapshots of the items are one a quarter: an item's type comes and
goes with its key, its size grows, and it vanishes for a while."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..plans import history as hist
from ..plans import inventory as inv
from ..registry import register

MOVES_SQL = """m AS (SELECT CASE WHEN l_partkey % 50 <> 0 THEN l_partkey END AS item, CAST(o_orderdate AS DATE) AS placed, CAST(l_shipdate AS DATE) AS shipped,
  CAST(l_quantity AS BIGINT) AS units, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100 AS BIGINT) AS cents, l_linenumber % 2 = 0 AS supply
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""


def _lines(spark, d):
    o = fx.table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("placed"))
    return fx.table(spark, d, "lineitem").join(o, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.when(F.col("l_partkey") % 50 != 0, F.col("l_partkey")).alias("item"), "placed", F.col("l_shipdate").cast("date").alias("shipped"),
        F.col("l_quantity").cast("long").alias("units"), (F.col("l_extendedprice").cast("decimal(18,2)") * 100).cast("long").alias("cents"),
        (F.col("l_linenumber") % 2 == 0).alias("supply"))


@register("r13_fifo_matches", f"""
WITH {MOVES_SQL},
r AS (SELECT item, shipped AS day, sum(units) AS n, sum(sum(units)) OVER (PARTITION BY item ORDER BY shipped) AS e FROM m WHERE supply GROUP BY 1, 2),
s AS (SELECT item, placed AS day, sum(units) AS n, sum(sum(units)) OVER (PARTITION BY item ORDER BY placed) AS e FROM m WHERE NOT supply GROUP BY 1, 2),
t AS (SELECT item, max(CASE WHEN k = 'r' THEN e END) AS re, max(CASE WHEN k = 's' THEN e END) AS se
  FROM (SELECT 'r' AS k, * FROM r UNION ALL SELECT 's', * FROM s) GROUP BY item)
SELECT r.item, r.day AS receipt_day, s.day AS sale_day, CAST(least(r.e, s.e) - greatest(r.e - r.n, s.e - s.n) AS BIGINT) AS units
FROM r JOIN s ON r.item IS NOT DISTINCT FROM s.item AND r.e > s.e - s.n AND s.e > r.e - r.n
UNION ALL SELECT r.item, r.day, NULL, CAST(r.e - greatest(r.e - r.n, coalesce(se, 0)) AS BIGINT) FROM r JOIN t ON r.item IS NOT DISTINCT FROM t.item WHERE r.e > coalesce(se, 0)
UNION ALL SELECT s.item, NULL, s.day, CAST(s.e - greatest(s.e - s.n, coalesce(re, 0)) AS BIGINT) FROM s JOIN t ON s.item IS NOT DISTINCT FROM t.item WHERE s.e > coalesce(re, 0)
""", "R13")
def r13_fifo_matches(spark, d):
    m = _lines(spark, d)
    return inv.fifo_match(m.where("supply").withColumn("day", F.col("shipped")), m.where("NOT supply").withColumn("day", F.col("placed")))


@register("r13_inventory_day_facts", f"""
WITH {MOVES_SQL},
a AS (SELECT item, shipped AS day, units AS received, cents, units * (shipped - placed) AS lead, 0 AS sold, 0 AS ordered FROM m WHERE supply
  UNION ALL SELECT item, placed, 0, 0, 0, 0, units FROM m WHERE supply
  UNION ALL SELECT item, placed, 0, 0, 0, units, 0 FROM m WHERE NOT supply),
d AS (SELECT item, day, sum(received) AS received, sum(cents) AS cents, sum(lead) AS lead, sum(sold) AS sold, sum(ordered) AS ordered FROM a GROUP BY 1, 2),
w AS (SELECT *, sum(received) OVER u AS r, sum(cents) OVER u AS rc, sum(sold) OVER u AS s, sum(ordered) OVER u AS o,
  coalesce(sum(received) OVER g, 0) AS ro, coalesce(sum(cents) OVER g, 0) AS rco FROM d
  WINDOW u AS (PARTITION BY item ORDER BY day), g AS (PARTITION BY item ORDER BY day RANGE BETWEEN UNBOUNDED PRECEDING AND INTERVAL 91 DAY PRECEDING)),
l AS (SELECT coalesce(item, -1) AS item, r, rc, received AS n, cents AS c FROM w WHERE received > 0),
j AS (SELECT w.*, CAST(l.rc AS DOUBLE) - CAST((l.r - w.s) * l.c AS DOUBLE) / CAST(l.n AS DOUBLE) AS gone
  FROM w ASOF LEFT JOIN l ON coalesce(w.item, -1) = l.item AND w.s <= l.r)
SELECT item, day, CAST(received AS BIGINT) AS netReceivedInventoryUnits, CAST(cents AS DOUBLE) / 100 AS netReceivedInventoryCost,
  CAST(greatest(r - s, 0) AS BIGINT) AS sellableOnHandInventoryUnits, CASE WHEN r > s THEN (CAST(rc AS DOUBLE) - gone) / 100 ELSE 0 END AS sellableOnHandInventoryCost,
  CAST(greatest(ro - s, 0) AS BIGINT) AS aged90PlusDaysSellableInventoryUnits,
  CASE WHEN ro > s THEN (CAST(rco AS DOUBLE) - gone) / 100 ELSE 0 END AS aged90PlusDaysSellableInventoryCost,
  CAST(greatest(o - r, 0) AS BIGINT) AS openPurchaseOrderUnits, CAST(greatest(s - r, 0) AS BIGINT) AS unfilledCustomerOrderedUnits,
  CAST(sold AS DOUBLE) / nullif(CAST(greatest(r - received - (s - sold), 0) + received AS DOUBLE), 0) AS sellThroughRate,
  CAST(lead AS DOUBLE) / nullif(CAST(received AS DOUBLE), 0) AS averageVendorLeadTimeDays
FROM j""", "R13")
def r13_inventory_day_facts(spark, d):
    m, none = _lines(spark, d), F.lit(0).cast("long")

    # a line is one movement, or two: a purchase order is placed and received
    def move(day, received=none, cents=none, lead=none, sold=none, ordered=none):
        return F.struct(day.alias("day"), received.alias("received"), cents.alias("received_cents"), lead.alias("lead_days"), sold.alias("sold"), ordered.alias("ordered"))
    units, placed, shipped = F.col("units"), F.col("placed"), F.col("shipped")
    lead = (units * F.date_diff(shipped, placed)).cast("long")
    moves = F.when(F.col("supply"), F.array(move(shipped, units, F.col("cents"), lead), move(placed, ordered=units))).otherwise(F.array(move(placed, sold=units)))
    return inv.inventory_day_facts(m.select("item", F.explode(moves).alias("m")).select("item", "m.*"))


SNAPSHOT_DAYS = "sequence(DATE '1992-01-01', DATE '1998-10-01', interval 3 month)"
SNAPSHOTS_SQL = """days AS (SELECT CAST(unnest(generate_series(TIMESTAMP '1992-01-01', TIMESTAMP '1998-10-01', INTERVAL 3 MONTH)) AS DATE) AS day),
q AS (SELECT day, (year(day) - 1992) * 4 + quarter(day) - 1 AS n FROM days),
snap AS (SELECT CASE WHEN p_partkey % 97 <> 0 THEN p_partkey END AS item, day, n, CASE WHEN (p_partkey + n // 9) % 5 <> 0 THEN p_type END AS item_type,
  CAST(p_size + (n + p_partkey % 6) // 6 AS BIGINT) AS item_size FROM part, q WHERE (p_partkey + n // 4) % 7 <> 0),
v AS (SELECT item, day, n, max(struct_pack(item_type := item_type, item_size := item_size)) AS v FROM (
    SELECT item, day, n, item_type, item_size, row_number() OVER (PARTITION BY item, day ORDER BY item_type NULLS FIRST, item_size) = count(*) OVER (PARTITION BY item, day) AS top FROM snap)
  WHERE top GROUP BY 1, 2, 3),
g AS (SELECT *, CASE WHEN lag(n) OVER k = n - 1 AND lag(v) OVER k IS NOT DISTINCT FROM v THEN 0 ELSE 1 END AS fresh FROM v WINDOW k AS (PARTITION BY item ORDER BY n)),
r AS (SELECT *, sum(fresh) OVER (PARTITION BY item ORDER BY n) AS run FROM g),
hist AS (SELECT item, item_type, item_size, valid_from, q.day AS valid_to FROM (
    SELECT item, (any_value(v)).item_type AS item_type, (any_value(v)).item_size AS item_size, min(day) AS valid_from, max(n) AS last FROM r GROUP BY item, run)
  LEFT JOIN q ON q.n = last + 1)"""


def _history(spark, d):
    # a small file is one split: its rows are spread before each becomes many (a number given: AQE merges none)
    p = fx.table(spark, d, "part").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "p_partkey")
    p = p.withColumn("day", F.explode(F.expr(SNAPSHOT_DAYS)))
    n, key = (F.year("day") - 1992) * 4 + F.quarter("day") - 1, F.col("p_partkey")
    p = p.withColumn("n", n).where(F.expr("(p_partkey + n div 4) % 7 <> 0"))
    snaps = p.select(F.when(key % 97 != 0, key).alias("item"), "day", F.when(F.expr("(p_partkey + n div 9) % 5 <> 0"), F.col("p_type")).alias("item_type"),
                     F.expr("p_size + (n + p_partkey % 6) div 6").cast("long").alias("item_size"))
    return hist.snapshot_history(snaps, ["item"], "day", ["item_type", "item_size"])


@register("r14_snapshot_history", f"WITH {SNAPSHOTS_SQL} SELECT * FROM hist", "R14", "P11")
def r14_snapshot_history(spark, d):
    return _history(spark, d)


@register("r14_sales_by_valid_item", f"""
WITH {SNAPSHOTS_SQL},
f AS (SELECT CASE WHEN l_partkey % 97 <> 0 THEN l_partkey END AS item, CAST(l_shipdate AS DATE) AS day, CAST(l_quantity AS BIGINT) AS units FROM lineitem)
SELECT item_type, item_size, CAST(sum(units) AS BIGINT) AS units, count(*) AS n_lines
FROM f LEFT JOIN hist h ON f.item IS NOT DISTINCT FROM h.item AND f.day >= valid_from AND (valid_to IS NULL OR f.day < valid_to) GROUP BY 1, 2""", "R14", "P11")
def r14_sales_by_valid_item(spark, d):
    f = fx.table(spark, d, "lineitem").select(F.when(F.col("l_partkey") % 97 != 0, F.col("l_partkey")).alias("item"), F.col("l_shipdate").cast("date").alias("day"),
                                              F.col("l_quantity").cast("long").alias("units"))
    return hist.join_valid(f, _history(spark, d), ["item"], "day").groupBy("item_type", "item_size").agg(
        F.sum("units").alias("units"), F.count("*").alias("n_lines"))
