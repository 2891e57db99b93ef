"""Registered queries over landed documents of unlike shape."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import fixtures as fx
from ..registry import register
from ..sources.drift import flatten_variant, read_variant_documents
from .io import _scratch


@register("s1_drifting_documents", """
WITH o AS (SELECT o_orderkey AS k, CAST(o_orderkey % 5 AS INTEGER) AS s, CAST(o_custkey AS BIGINT) AS c, * FROM orders)
SELECT CASE WHEN s = 1 THEN 'K' || k ELSE CAST(k AS VARCHAR) END AS id, CASE WHEN s = 1 THEN CAST(c AS VARCHAR) END AS buyer,
  CASE WHEN s = 0 THEN c END AS buyer_key, CASE WHEN s = 4 THEN c END AS buyer_key_no, CASE WHEN s = 0 THEN o_orderpriority END AS buyer_tier,
  CASE WHEN s = 2 THEN true END AS buyer_known, CASE WHEN s = 0 THEN o_totalprice WHEN s = 3 THEN floor(o_totalprice) END AS price,
  CASE WHEN s = 1 THEN o_orderstatus END AS status, CASE WHEN s = 1 THEN strftime(o_orderdate, '%Y-%m-%d') END AS ship_day,
  CASE WHEN s = 2 THEN '[{"n":1},{"n":"' || o_orderpriority || '"}]' END AS lines, CAST(NULL AS VARCHAR) AS malformed
FROM o WHERE k % 10 <> 9
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '{"id":' || k || ',"buyer":' FROM o WHERE k % 10 = 9""", "S1", "F1", "F12")
def s1_drifting_documents(spark, d):
    """Every order as one document of five layouts: ids are numbers or texts, a buyer is an object, a text, or an object
    whose key is an object; every tenth document is cut short."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    layouts = [
        F.struct(key.alias("id"), F.struct(cust.alias("key"), F.col("o_orderpriority").alias("tier")).alias("buyer"), F.col("o_totalprice").alias("price")),
        F.struct(F.concat(F.lit("K"), key).alias("id"), cust.cast("string").alias("buyer"), F.struct(
            F.col("o_orderstatus").alias("status"), F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("day")).alias("ship")).alias("note")),
        F.struct(key.alias("id"), F.lit(True).alias("Buyer"), F.array(
            F.lit('{"n":1}'), F.concat(F.lit('{"n":"'), F.col("o_orderpriority"), F.lit('"}'))).cast("array<string>").alias("lines")),
        F.struct(key.alias("id"), F.struct().alias("buyer"), F.floor("o_totalprice").alias("price")),
        F.struct(key.alias("id"), F.struct(F.struct(cust.alias("no")).alias("key")).alias("buyer")),
    ]
    # an array whose elements are unlike each other has no type of its own: its elements go in as text
    lines = F.concat(F.lit('{"id":'), key, F.lit(',"Buyer":true,"price":null,"lines":['), F.array_join(layouts[2]["lines"], ","), F.lit("]}"))
    text = F.when(key % 10 == 9, F.concat(F.lit('{"id":'), key, F.lit(',"buyer":')))
    for n, layout in enumerate(layouts):
        text = text.when(key % 5 == n, lines if n == 2 else F.to_json(layout))
    path = _scratch(spark, "drifting")
    fx.table(spark, d, "orders").select(text.alias("value")).write.text(path)
    docs = read_variant_documents(spark, path, lines=True)
    names = {"id": "id", "buyer__2": "buyer", "buyer.key": "buyer_key", "buyer.key.no": "buyer_key_no", "buyer.tier": "buyer_tier", "Buyer": "buyer_known",
             "price": "price", "note.status": "status", "note.ship.day": "ship_day", "lines": "lines", "malformed": "malformed"}
    flat = flatten_variant(docs, keep=["malformed"])
    return flat.select(*[(F.col(f"`{a}`").cast("double") if a == "price" else F.col(f"`{a}`")).alias(b) for a, b in names.items()])
