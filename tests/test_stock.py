import datetime as dt
import random
from collections import Counter, deque

from pyspark.sql import functions as F

from shelfscope.plans import history as hist
from shelfscope.plans import inventory as inv

DAY0 = dt.date(2024, 1, 1)


def day(n):
    return DAY0 + dt.timedelta(days=n)


def moves(seed, items=(1, 2, None), n=60):
    r = random.Random(seed)
    return [(i, day(r.randrange(300)), r.choice(["in", "out", "in"]), r.choice([0, 1, 5, 12])) for i in items for _ in range(n)]


def fifo(rows, item):
    """Every unit of one item by hand: (receipt day, sale day) of unit k of both totals."""
    ins = [d for _, d, k, u in sorted((x for x in rows if x[0] == item), key=lambda x: x[1]) if k == "in" for _ in range(u)]
    outs = [d for _, d, k, u in sorted((x for x in rows if x[0] == item), key=lambda x: x[1]) if k == "out" for _ in range(u)]
    n = max(len(ins), len(outs))
    return Counter(zip(ins + [None] * (n - len(ins)), outs + [None] * (n - len(outs))))


def test_fifo_match_equals_a_queue_of_units(spark):
    for seed in range(3):
        rows = moves(seed)
        df = spark.createDataFrame(rows, "item int, day date, kind string, units long")
        got = inv.fifo_match(df.where("kind = 'in'"), df.where("kind = 'out'")).collect()
        for i in (1, 2, None):
            assert Counter({(r.receipt_day, r.sale_day): r.units for r in got if r.item == i}) == fifo(rows, i)
    none = df.limit(0)
    assert inv.fifo_match(none, none).count() == 0
    only = inv.fifo_match(df.where("kind = 'in'"), none)
    assert only.where("sale_day IS NOT NULL").count() == 0 and only.agg(F.sum("units")).first()[0] == sum(u for *_, k, u in rows if k == "in")


def test_inventory_equals_stock_kept_by_hand(spark):
    r = random.Random(7)
    rows = []
    for i in (1, None):
        for _ in range(80):
            n, u = r.randrange(400), r.choice([1, 4, 9])
            if r.random() < 0.55:
                lead, cents = r.randrange(20), r.randrange(100, 999)
                rows += [(i, day(n), u, u * cents, u * lead, 0, 0), (i, day(n - lead), 0, 0, 0, 0, u)]
            else:
                rows.append((i, day(n), 0, 0, 0, u, 0))
    got = inv.inventory_day_facts(spark.createDataFrame(rows, "item int, day date, received long, received_cents long, lead_days long, sold long, ordered long")).collect()
    assert len(got) == len({x[:2] for x in rows})
    for i in (1, None):
        mine = [x for x in rows if x[0] == i]
        stock, owed, on_order = deque(), 0, 0   # units in stock as (day, cents); sold ones not yet received
        for g in sorted((g for g in got if g.item == i), key=lambda g: g.day):
            today = [x for x in mine if x[1] == g.day]
            opening = len(stock)
            came = sum(x[2] for x in today)
            cents = sum(x[3] for x in today)
            sold = sum(x[5] for x in today)
            stock.extend([(g.day, cents / came)] * came if came else [])
            owed += sold
            while owed and stock:
                stock.popleft()
                owed -= 1
            on_order += sum(x[6] for x in today) - came
            old = [c for d, c in stock if (g.day - d).days > 90]
            assert (g.netReceivedInventoryUnits, g.sellableOnHandInventoryUnits, g.unfilledCustomerOrderedUnits, g.openPurchaseOrderUnits,
                    g.aged90PlusDaysSellableInventoryUnits) == (came, len(stock), owed, max(on_order, 0), len(old))
            assert abs(g.sellableOnHandInventoryCost * 100 - sum(c for _, c in stock)) < 1e-4
            assert abs(g.aged90PlusDaysSellableInventoryCost * 100 - sum(old)) < 1e-4
            assert g.sellThroughRate == (sold / (opening + came) if opening + came else None)


def test_history_of_snapshots_and_join_of_the_valid_version(spark):
    r = random.Random(3)
    dates = [day(n) for n in (0, 10, 40, 41, 130, 400)]
    snaps = [(k, d, r.choice(["a", "b", None]), r.choice([1, 2])) for k in [*range(12), None] for d in dates if r.random() < 0.7]
    snaps += [(0, dates[2], "z", 9), (0, dates[2], "z", 9), (0, dates[2], "a", 1)]  # repeated keys: the greatest counts
    h = hist.snapshot_history(spark.createDataFrame(snaps, "k int, d date, t string, s int"), ["k"], "d", ["t", "s"])

    def at(k, d):
        seen = [x for x in dates if x <= d]
        rows = [(t is not None, t, s) for kk, dd, t, s in snaps if kk == k and seen and dd == seen[-1]]
        return max(rows, key=lambda x: (x[0], x[1] or "", x[2]))[1:] if rows else None
    rows = h.collect()
    for k in [*range(12), None]:
        mine = sorted((x for x in rows if x.k == k), key=lambda x: x.valid_from)
        for a, b in zip(mine, mine[1:]):
            assert a.valid_to <= b.valid_from and ((a.t, a.s) != (b.t, b.s) or a.valid_to < b.valid_from)
        for d in [x for y in dates for x in (y, y - dt.timedelta(days=1), y + dt.timedelta(days=1))]:
            now = [(x.t, x.s) for x in mine if x.valid_from <= d and (x.valid_to is None or d < x.valid_to)]
            assert now == ([at(k, d)] if at(k, d) else [])
    facts = [(i, r.choice([*range(13), None]), day(r.randrange(-5, 500))) for i in range(400)] + [(900, 1, None)]
    f = spark.createDataFrame(facts, "id int, k int, day date")
    got = {x.id: (x.t, x.s) for x in hist.join_valid(f, h, ["k"], "day").collect()}
    assert got == {i: (at(k, d) if d and at(k, d) else (None, None)) for i, k, d in facts}
    assert hist.join_valid(f, h, ["k"], "day", "inner").count() == sum(bool(d and at(k, d)) for _, k, d in facts)
    assert hist.join_valid(f, h.limit(0), ["k"], "day").count() == len(facts) and hist.join_valid(f.limit(0), h, ["k"], "day").count() == 0
