"""R13, inventory: stock by first in, first out.

Receipts and sales of an item are two running totals over the same units.  The unit at position ``p`` of the
receipts' total leaves as the unit at position ``p`` of the sales' total, so matching them needs no range join: the ends of
both totals are sorted together, and every stretch between two neighbouring ends lies in one receipt and one sale, the
nearest that end at or behind it.

Movements are summed by item and day first (combined map-side), so an item's window holds one row a day at most,
however many movements it has; that bounds the window of the hottest item by the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

AGED_DAYS = 90


def _running(df: DataFrame, item: str, day: str, units: str) -> DataFrame:
    w = Window.partitionBy(item).orderBy(day).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.groupBy(item, day).agg(F.sum(units).alias("units")).where("units > 0").withColumn("to", F.sum("units").over(w))


def fifo_match(receipts: DataFrame, sales: DataFrame, item: str = "item", day: str = "day", units: str = "units") -> DataFrame:
    """``receipts`` and ``sales`` (item, day, units) -> (item, receipt_day, sale_day, units): how many units received on
    one day left on the other.  Units still in stock have no sale_day; units sold but not yet received have no
    receipt_day.  Units are whole numbers; days without units play no part; a null item is one of its own."""
    ends = (_running(receipts, item, day, units).select(F.col(item).alias("item"), "to", F.col(day).alias("receipt_day"), F.lit(None).cast("date").alias("sale_day"))
            .unionByName(_running(sales, item, day, units).select(F.col(item).alias("item"), "to", F.lit(None).cast("date").alias("receipt_day"),
                                                                  F.col(day).alias("sale_day"))))
    by = Window.partitionBy("item").orderBy("to")
    # equal ends make a stretch without units; either order gives the other the same receipt and sale
    behind = by.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    out = ends.select("item", F.first("receipt_day", ignorenulls=True).over(behind).alias("receipt_day"),
                      F.first("sale_day", ignorenulls=True).over(behind).alias("sale_day"),
                      (F.col("to") - F.coalesce(F.lag("to").over(by), F.lit(0))).alias("units"))
    return out.where("units > 0").select(F.col("item").alias(item), "receipt_day", "sale_day", "units")


def inventory_day_facts(moves: DataFrame, item: str = "item", day: str = "day", aged_days: int = AGED_DAYS) -> DataFrame:
    """``moves`` (item, day, received, received_cents, lead_days, sold, ordered) -> the stock facts of each item and day with a
    movement.  ``lead_days``: the received units times their days from order to receipt; ``ordered``: units of purchase orders placed.

    On hand is what was received and not yet sold, unfilled what was sold and not yet received, open what was ordered and not yet
    received.  The stock's cost is that of the latest receipts, the last one taken in part.  Aged stock
    was received more than ``aged_days`` before.  Sell-through: sold of what was on hand or came in that day."""
    sums = ("received", "received_cents", "lead_days", "sold", "ordered")
    d = moves.groupBy(F.col(item).alias("item"), F.col(day).alias("day")).agg(*[F.sum(c).alias(c) for c in sums])
    d = d.withColumn("number", F.unix_date("day"))
    by = Window.partitionBy("item").orderBy("number")
    upto = by.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    old = by.rangeBetween(Window.unboundedPreceding, -aged_days - 1)
    total = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0)).cast("long")
    d = d.select("*", total("received", upto).alias("r"), total("received_cents", upto).alias("rc"), total("sold", upto).alias("s"),
                 total("ordered", upto).alias("o"), total("received", old).alias("r_old"), total("received_cents", old).alias("rc_old"))
    # the receipt in which the first unit on hand lies: ends of receipts and totals of sales sorted together
    lot = F.struct(F.col("r").alias("r"), F.col("rc").alias("rc"), F.col("received").alias("n"), F.col("received_cents").alias("c"))
    points = d.select("item", F.col("s").alias("at"), F.struct(*d.columns).alias("row"), F.lit(None).cast(d.select(lot).schema[0].dataType).alias("lot"))
    lots = d.where("received > 0").select("item", F.col("r").alias("at"), F.lit(None).cast(points.schema["row"].dataType).alias("row"), lot.alias("lot"))
    behind = Window.partitionBy("item").orderBy("at").rowsBetween(Window.currentRow, Window.unboundedFollowing)
    j = points.unionByName(lots).withColumn("lot", F.first("lot", ignorenulls=True).over(behind)).where("row IS NOT NULL").select("row.*", "lot")
    # cost of all units received before the first one on hand
    gone = F.col("lot.rc").cast("double") - ((F.col("lot.r") - F.col("s")) * F.col("lot.c")).cast("double") / F.col("lot.n").cast("double")
    stock, aged = F.col("r") - F.col("s"), F.col("r_old") - F.col("s")
    opening = F.greatest(F.col("r") - F.col("received") - (F.col("s") - F.col("sold")), F.lit(0)) + F.col("received")
    euros = lambda units, cents: F.when(units > 0, (cents.cast("double") - gone) / 100).otherwise(0.0)
    return j.select(
        F.col("item").alias(item), F.col("day").alias(day),
        F.col("received").cast("long").alias("netReceivedInventoryUnits"), (F.col("received_cents").cast("double") / 100).alias("netReceivedInventoryCost"),
        F.greatest(stock, F.lit(0)).alias("sellableOnHandInventoryUnits"), euros(stock, F.col("rc")).alias("sellableOnHandInventoryCost"),
        F.greatest(aged, F.lit(0)).alias("aged90PlusDaysSellableInventoryUnits"), euros(aged, F.col("rc_old")).alias("aged90PlusDaysSellableInventoryCost"),
        F.greatest(F.col("o") - F.col("r"), F.lit(0)).alias("openPurchaseOrderUnits"),
        F.greatest(-stock, F.lit(0)).alias("unfilledCustomerOrderedUnits"),
        F.try_divide(F.col("sold").cast("double"), opening.cast("double")).alias("sellThroughRate"),
        F.try_divide(F.col("lead_days").cast("double"), F.col("received").cast("double")).alias("averageVendorLeadTimeDays"))
