"""Declared reports R1-R14 (re-aimed: the reference names their measures and
lets a service compute them; here they are Spark aggregations over event
tables).  Formulas follow the usual meaning of each measure name.

Scale notes:
* attribution (R2) needs "last click of the same user at or before the
  purchase, within n days".  Instead of a range join it uses a per-user
  hourly table (one row per user and active hour) and a running window over
  hours, plus a window inside each (user, hour).  No pair of rows is ever
  emitted, clicks and purchases come from one scan of the events, and events
  without a user never meet.
* ranks over all keys (R12) are computed from a histogram of the ranked
  value, not from a single-partition window over every key.
* first-touch flags (R5, R7) are ``min`` aggregates joined back, not
  per-user windows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.setops import union_facts

WINDOW_DAYS = (1, 7, 14, 30)
DAY_US = 86400 * 1000000
SLICES = 64


def _lag_us(start: str, end: str) -> Column:
    """Microseconds from ``start`` to ``end`` (wall-clock, no time zone)."""
    return F.expr(f"timestampdiff(MICROSECOND, {start}, {end})")


# ----------------------------------------------------------------------------
# R2 / R3 attribution

CLICK_COLS = ("click_ts", "campaign_id", "advertised_sku")


def touches(purchases: DataFrame, clicks: DataFrame, ts: str = "ts") -> DataFrame:
    """Clicks and purchases as one table with an ``is_click`` flag (columns that
    only one of them has are NULL on the other)."""
    return (purchases.withColumn("is_click", F.lit(False))
            .unionByName(clicks.withColumn(ts, F.col("click_ts")).withColumn("is_click", F.lit(True)), allowMissingColumns=True))


def last_touch_of(both: DataFrame, cols: Sequence[str], kinds: Sequence[str], user: str = "user_id", ts: str = "ts",
                  bucket: str = "hour") -> DataFrame:
    """Rows with a ``touch`` column (a kind, NULL on a purchase) -> the purchases,
    each with one struct ``last_<kind>`` of ``cols`` for every kind: the latest
    touch of that kind by the same user at or before it (NULL when none, and for
    purchases without a user).  ``cols`` start with the time of the touch.

    Time is cut into ``bucket`` periods: the touch of the same period comes from a
    window inside one (user, period), an earlier one from a running max over the
    user's active periods (one row each, combined map-side), so no window ever
    holds a user's whole history of events.  All kinds share both shuffles."""
    of = {k: F.when(F.col("touch") == k, F.struct(*[F.col(x) for x in cols])) for k in kinds}
    keep = [c for c in both.columns if c not in (*cols, "touch")]
    known = both.where(F.col(user).isNotNull()).withColumn("__hour", F.date_trunc(bucket, F.col(ts)))
    hours = known.groupBy(user, "__hour").agg(*[F.max(of[k]).alias(f"__last_{k}") for k in kinds])
    before = Window.partitionBy(user).orderBy("__hour").rowsBetween(Window.unboundedPreceding, -1)
    hours = hours.select(user, "__hour", *[F.max(f"__last_{k}").over(before).alias(f"__prior_{k}") for k in kinds])
    inside = (Window.partitionBy(user, "__hour").orderBy(F.col(ts), F.col("touch").isNull())
              .rowsBetween(Window.unboundedPreceding, 0))
    bought = known.select("*", *[F.max(of[k]).over(inside).alias(f"__same_{k}") for k in kinds]).where(F.col("touch").isNull())
    out = bought.join(hours, [user, "__hour"], "left").select(
        *keep, *[F.coalesce(F.col(f"__same_{k}"), F.col(f"__prior_{k}")).alias(f"last_{k}") for k in kinds])
    nobody = both.where(F.col(user).isNull() & F.col("touch").isNull()).select(
        *keep, *[F.lit(None).cast(out.schema[f"last_{k}"].dataType).alias(f"last_{k}") for k in kinds])
    return out.unionByName(nobody)


def last_click_of(both: DataFrame, click_cols: Sequence[str], user: str = "user_id", ts: str = "ts",
                  bucket: str = "hour") -> DataFrame:
    """Rows of ``touches`` -> its purchases, each with the columns of the latest
    click of the same user at or before it (``last_touch_of`` with one kind)."""
    one = both.withColumn("touch", F.when(F.col("is_click"), F.lit("click"))).drop("is_click")
    out = last_touch_of(one, click_cols, ["click"], user, ts, bucket)
    return out.select(*[c for c in out.columns if c != "last_click"], *[F.col("last_click")[x].alias(x) for x in click_cols])


def last_click(purchases: DataFrame, clicks: DataFrame, user: str = "user_id", ts: str = "ts",
               click_cols: Sequence[str] = CLICK_COLS, bucket: str = "hour") -> DataFrame:
    """``last_click_of`` two tables; ``clicks`` has ``click_cols`` with
    ``click_ts`` the click time."""
    return last_click_of(touches(purchases, clicks.select(user, *click_cols), ts), click_cols, user, ts, bucket)


def _in_windows(credited: DataFrame, days: Sequence[int], sku: str) -> DataFrame:
    lag = _lag_us("click_ts", "ts")
    out = credited.withColumn("click_day", F.col("click_ts").cast("date"))
    for n in days:
        out = out.withColumn(f"in_{n}d", lag <= F.lit(n * DAY_US))
    return out.withColumn("same_sku", F.col(sku).eqNullSafe(F.col("advertised_sku")))


def attribute(both: DataFrame, click_cols: Sequence[str] = CLICK_COLS, days: Sequence[int] = WINDOW_DAYS,
              sku: str = "sku") -> DataFrame:
    """R2 + R3: purchases of ``touches`` credited to the campaign of the user's
    last click within ``max(days)`` days (last click wins), with one flag per
    window and a same-item flag (bought item == advertised item)."""
    lc = last_click_of(both, click_cols)
    lag = _lag_us("click_ts", "ts")
    return _in_windows(lc.where(F.col("click_ts").isNotNull() & (lag <= F.lit(max(days) * DAY_US))), days, sku)


def attribute_views(both: DataFrame, click_cols: Sequence[str] = CLICK_COLS, days: Sequence[int] = WINDOW_DAYS,
                    sku: str = "sku", view_days: int = 14) -> DataFrame:
    """The credits of ``attribute``, and view-through ones (``by_view``) for display
    ads: a purchase without a click in the ``view_days`` before it goes to the
    user's last view in them.  ``both`` has ``touch``: 'click', 'view', or NULL on a
    purchase; ``click_cols`` hold the touch of either kind.  A purchase has at
    most one credit of each kind, found in one pass."""
    lt = last_touch_of(both, click_cols, ["click", "view"])

    def within(kind: str, n: int) -> Column:
        return F.coalesce(_lag_us(f"last_{kind}.click_ts", "ts") <= F.lit(n * DAY_US), F.lit(False))

    def credit(kind: str) -> Column:
        return F.struct(F.col(f"last_{kind}").alias("touch"), F.lit(kind == "view").alias("by_view"))

    credits = F.array_compact(F.array(F.when(within("click", max(days)), credit("click")),
                                      F.when(~within("click", view_days) & within("view", view_days), credit("view"))))
    keep = [c for c in lt.columns if c not in ("last_click", "last_view")]
    out = lt.select(*keep, F.explode(credits).alias("__credit"))
    return _in_windows(out.select(*keep, F.col("__credit.by_view").alias("by_view"),
                                  *[F.col("__credit.touch")[x].alias(x) for x in click_cols]), days, sku)


# name of the measure: (what it sums, which purchases of the window count)
ATTRIBUTED = {
    "purchases": ("1", "all"), "sales": ("sales", "all"), "unitsSoldClicks": ("units", "all"),
    "purchasesSameSku": ("1", "same"), "attributedSalesSameSku": ("sales", "same"), "unitsSoldSameSku": ("units", "same"),
    "purchasesOtherSku": ("1", "other"), "salesOtherSku": ("sales", "other"), "unitsSoldOtherSku": ("units", "other"),
}
# New-to-brand measures count the purchases of a 14-day window, view-through ones too.
NEW_TO_BRAND = {"newToBrandPurchases": "1", "newToBrandSales": "sales", "newToBrandUnitsSold": "units"}
VIEW_THROUGH = {"purchasesViews": "1", "salesViews": "sales", "unitsSoldViews": "units"}
NEW_TO_BRAND_DAYS = 14
MONEY = "decimal(28,2)"


def attributed_sums(attributed: DataFrame, dims: Sequence[str] = ("click_day", "campaign_id"),
                    days: Sequence[int] = WINDOW_DAYS, money: str = "double", wanted: Sequence[str] | None = None) -> DataFrame:
    """Per click day and dimensions: purchases / sales / units per window: total,
    of the advertised item and of other items; new-to-brand ones if the input
    flags them (``ntb``).  Rows that a view won (``by_view``) are summed apart, in
    measures that end in ``Views``.  Sums without rows are 0; sums are exact and
    cast to ``money`` once.  ``wanted`` leaves out every other measure."""
    count = {"all": "true", "same": "same_sku", "other": "NOT same_sku"}
    aggs = {f"{m}{n}d": (what, f"in_{n}d AND {count[which]}") for n in days for m, (what, which) in ATTRIBUTED.items()}
    last = f"in_{NEW_TO_BRAND_DAYS}d"
    if "ntb" in attributed.columns:
        aggs |= {m: (what, f"{last} AND ntb") for m, what in NEW_TO_BRAND.items()}
    if "by_view" in attributed.columns:
        aggs = {m: (what, f"NOT by_view AND {cond}") for m, (what, cond) in aggs.items()}
        aggs |= {m: (what, f"by_view AND {last}") for m, what in VIEW_THROUGH.items()}
        if "ntb" in attributed.columns:
            aggs |= {f"{m}Views": (what, f"by_view AND {last} AND ntb") for m, what in NEW_TO_BRAND.items()}
    sums = [F.expr(f"CAST(sum(CASE WHEN {cond} THEN {what} ELSE 0 END) AS {money if what == 'sales' else 'bigint'}) AS {m}")
            for m, (what, cond) in aggs.items() if wanted is None or m in wanted]
    rows = attributed.groupBy(*dims)
    return rows.agg(*sums) if sums else attributed.select(*dims).distinct()


# ----------------------------------------------------------------------------
# R1 / R4 report spec runner and measure registry

@dataclass(frozen=True)
class Measure:
    """A column of a declared report: the summed measures it reads, and its SQL."""
    needs: tuple[str, ...]
    sql: str


def _total(names: Sequence[str], kind: str) -> str:
    return f"CAST({' + '.join(f'coalesce({m}, 0)' for m in names)} AS {kind})"


def _count(*names: str) -> Measure:
    return Measure(names, _total(names, "bigint"))


def _value(*names: str) -> Measure:
    return Measure(names, _total(names, "double"))


def _ratio(a: str, b: str, times: str = "") -> Measure:
    return Measure((a, b), f"try_divide({_total([a], 'double')}{times}, {_total([b], 'double')})")


# Video progress (percent watched) of each funnel step.
FUNNEL_STEPS = {"videoFirstQuartileViews": 25, "videoMidpointViews": 50, "videoThirdQuartileViews": 75,
                "videoCompleteViews": 100}
TRAFFIC_MEASURES = ["impressions", "clicks", "cost", *FUNNEL_STEPS, "viewableImpressions", "video5SecondViews"]


def _measure_registry(days: Sequence[int] = WINDOW_DAYS) -> dict[str, Measure]:
    reg = {
        "impressions": _count("impressions"), "clicks": _count("clicks"), "cost": _value("cost"), "spend": _value("cost"),
        "clickThroughRate": _ratio("clicks", "impressions"),
        "costPerClick": _ratio("cost", "clicks"),
        "viewableImpressions": _count("viewableImpressions"), "impressionsViews": _count("viewableImpressions"),
        "viewabilityRate": _ratio("viewableImpressions", "impressions"),
        "viewClickThroughRate": _ratio("clicks", "viewableImpressions"),
        "video5SecondViews": _count("video5SecondViews"),
        "video5SecondViewRate": _ratio("video5SecondViews", "impressions"),
        **{m: _count(m) for m in FUNNEL_STEPS},
    }
    for n in days:
        for base, (what, _) in ATTRIBUTED.items():
            reg[f"{base}{n}d"] = _value(f"{base}{n}d") if what == "sales" else _count(f"{base}{n}d")
        reg[f"acosClicks{n}d"] = _ratio("cost", f"sales{n}d")
        reg[f"roasClicks{n}d"] = _ratio(f"sales{n}d", "cost")
    n = NEW_TO_BRAND_DAYS  # reports without a window in the name use this one
    for name, m in (("purchases", "purchases"), ("purchasesClicks", "purchases"), ("unitsSold", "unitsSoldClicks"),
                    ("unitsSoldClicks", "unitsSoldClicks"), ("purchasesPromoted", "purchasesSameSku"),
                    ("purchasesPromotedClicks", "purchasesSameSku"), (f"orders{n}d", "purchases"),
                    (f"ordersClicks{n}d", "purchases"), (f"unitsSold{n}d", "unitsSoldClicks")):
        reg[name] = _count(f"{m}{n}d")
    for name, m in (("sales", "sales"), ("salesClicks", "sales"), ("salesPromoted", "attributedSalesSameSku"),
                    ("salesPromotedClicks", "attributedSalesSameSku"), (f"salesClicks{n}d", "sales")):
        reg[name] = _value(f"{m}{n}d")
    for m, base in (("newToBrandPurchases", "purchases"), ("newToBrandSales", "sales"), ("newToBrandUnitsSold", "unitsSoldClicks")):
        reg[m] = reg[f"{m}Clicks"] = reg[f"{m}{n}d"] = _value(m) if base == "sales" else _count(m)
        reg[f"{m}Percentage"] = reg[f"{m}Percentage{n}d"] = _ratio(m, f"{base}{n}d", " * 100.0")
    reg["newToBrandPurchasesRate"] = _ratio("newToBrandPurchases", "impressions")
    return reg


MEASURES = _measure_registry()
# Display reports: names without "Clicks" count what a view won too.
DISPLAY_MEASURES = MEASURES | {
    "purchases": _count(f"purchases{NEW_TO_BRAND_DAYS}d", "purchasesViews"),
    "sales": _value(f"sales{NEW_TO_BRAND_DAYS}d", "salesViews"),
    "unitsSold": _count(f"unitsSoldClicks{NEW_TO_BRAND_DAYS}d", "unitsSoldViews"),
    "newToBrandPurchases": _count("newToBrandPurchases", "newToBrandPurchasesViews"),
    "newToBrandSales": _value("newToBrandSales", "newToBrandSalesViews"),
    "newToBrandUnitsSold": _count("newToBrandUnitsSold", "newToBrandUnitsSoldViews"),
}
BASE_MEASURES = frozenset(b for m in DISPLAY_MEASURES.values() for b in m.needs)
# Not sums: from ``cumulative_reach`` by the report's own grain.
REACH_MEASURES = ("cumulativeReach", "impressionsFrequencyAverage")
DIMENSIONS = {"date": "date", "campaignId": "campaign_id", "campaignName": "campaign_name", "adGroupName": "ad_group",
              "targeting": "targeting", "keyword": "targeting", "keywordText": "targeting", "targetingText": "targeting",
              "targetingExpression": "targeting", "placementClassification": "placement",
              "advertisedAsin": "advertised_sku", "advertisedSku": "advertised_sku", "promotedAsin": "advertised_sku",
              "promotedSku": "advertised_sku", "purchasedAsin": "sku"}
BOUGHT = "sku"  # the dimension that traffic lacks
# what each ``groupBy`` name of a declared report puts a row to (beside the date)
GRAINS = {"campaigns": ["campaign_id", "campaign_name"], "campaign": ["campaign_id", "campaign_name"], "adGroup": ["campaign_id", "campaign_name", "ad_group"],
          "advertiser": ["campaign_id", "campaign_name", "ad_group", "advertised_sku"],
          "targeting": ["campaign_id", "campaign_name", "ad_group", "targeting"],
          "campaignPlacement": ["campaign_id", "campaign_name", "placement"],
          "asin": ["campaign_id", "campaign_name", "ad_group", "targeting", "advertised_sku", "sku"],
          "purchasedAsin": ["campaign_id", "campaign_name", "ad_group", "sku"]}


@dataclass(frozen=True)
class ReportSpec:
    """A declared report: ``group_by`` names of GRAINS or DIMENSIONS (the time
    unit's ``date`` is always included) and requested ``columns``; ``display``
    reports count view-through purchases."""
    group_by: Sequence[str]
    columns: Sequence[str]
    filters: Mapping[str, Sequence[str]] = field(default_factory=dict)
    display: bool = False

    def dims(self) -> list[str]:
        """What a row stands for, beside the date: the grain and the dimensions asked for."""
        out = []
        for g in self.group_by:
            out += GRAINS.get(g) or [DIMENSIONS[g]]
        out += [DIMENSIONS[c] for c in self.columns if c in DIMENSIONS]
        return [d for d in dict.fromkeys(out) if d != "date"]

    def measures(self) -> dict[str, Measure]:
        """The requested measures; unknown names fail."""
        known = DISPLAY_MEASURES if self.display else MEASURES
        unknown = [c for c in self.columns if c not in known and c not in DIMENSIONS and c not in REACH_MEASURES]
        if unknown:
            raise KeyError(f"unknown report columns: {unknown}")
        return {c: known[c] for c in self.columns if c in known}

    def needs(self) -> list[str]:
        """The summed measures that the requested columns read."""
        return list(dict.fromkeys(b for m in self.measures().values() for b in m.needs))


def traffic_sums(traffic: DataFrame, dims: Sequence[str], wanted: Sequence[str] | None = None, viewable_at: int = 10,
                 five_seconds_at: int = 20) -> DataFrame:
    """Daily sums of views and clicks by ``dims`` (a day of other events alone is
    a row of zeros).  ``viewable_at`` and ``five_seconds_at`` are the percent of the
    ad that stand for a viewable impression and for five seconds watched."""
    shown = F.col("event_type").isin("view", "click")
    click = F.col("event_type") == "click"
    aggs = {"impressions": F.count_if(shown), "clicks": F.count_if(click),
            "cost": F.coalesce(F.sum(F.when(click, F.col("value").cast("decimal(18,2)"))), F.lit(0)).cast(MONEY)}
    if "progress" in traffic.columns:
        steps = {**FUNNEL_STEPS, "viewableImpressions": viewable_at, "video5SecondViews": five_seconds_at}
        aggs |= {m: F.count_if(shown & (F.col("progress") >= at)) for m, at in steps.items()}
    aggs = {m: a for m, a in aggs.items() if wanted is None or m in wanted}
    days = [F.col("day").alias("date"), *dims]
    return traffic.groupBy(*days).agg(*[a.alias(m) for m, a in aggs.items()]) if aggs else traffic.select(*days).distinct()


def _measure_types(wanted: Sequence[str] | None, *tables: DataFrame) -> dict[str, str]:
    found = {c: t.schema[c].dataType.simpleString() for t in tables for c in t.columns if c in BASE_MEASURES}
    found |= {m: MONEY if m == "cost" else "bigint" for m in TRAFFIC_MEASURES if m not in found}
    return {m: k for m, k in found.items() if wanted is None or m in wanted}


def _summed(df: DataFrame, dims: Sequence[str], measures: Mapping[str, str | None]) -> DataFrame:
    """One row per ``dims``: the measures summed (and cast, where a type is given)."""
    sums = [(F.sum(m).cast(k) if k else F.sum(m)).alias(m) for m, k in measures.items()]
    return df.groupBy(*dims).agg(*sums) if sums else df.select(*dims).distinct()


def ad_facts(traffic: DataFrame, attributed: DataFrame, dims: Sequence[str] = ("campaign_id",),
             viewable_at: int = 10, five_seconds_at: int = 20, wanted: Sequence[str] | None = None) -> DataFrame:
    """Daily facts by ``dims``, one row each: traffic sums plus attributed sums by
    click day (zero-filled union, one aggregate).  Traffic has no row where it
    lacks one of the dimensions (a bought item).  ``wanted`` (``ReportSpec.needs``)
    leaves out every other measure, so nothing else is read or summed."""
    a = attributed_sums(attributed, ["click_day", *dims], money=MONEY, wanted=wanted).withColumnRenamed("click_day", "date")
    if not set(dims) <= set(traffic.columns):
        return union_facts(a, a.limit(0), _measure_types(wanted, a))
    t = traffic_sums(traffic, dims, wanted, viewable_at, five_seconds_at)
    measures = _measure_types(wanted, t, a)
    return _summed(union_facts(t, a, measures), ["date", *dims], dict.fromkeys(measures))


def run_report(facts: DataFrame, spec: ReportSpec, dims_table: DataFrame | None = None, summed: bool = False,
               reach: DataFrame | None = None) -> DataFrame:
    """Evaluate a declared report.  Unknown column names fail.  ``summed``
    says that ``facts`` has one row per date and dimensions of the report already
    (as ``ad_facts`` of ``spec.dims()`` returns it), so nothing is summed again.
    ``reach``: ``cumulative_reach`` by the report's dimensions, for the columns
    that read it; a day without impressions keeps the reach of the day before."""
    measures = spec.measures()
    f = facts.join(dims_table, "campaign_id", "left") if dims_table is not None else facts
    for col, values in spec.filters.items():
        f = f.where(F.col(DIMENSIONS.get(col, col)).isin(list(values)))
    dims = ["date", *spec.dims()]
    g = f if summed else _summed(f, dims, dict.fromkeys(spec.needs()))
    asked = [c for c in spec.columns if c in REACH_MEASURES]
    if asked:
        if reach is None:
            raise ValueError(f"no reach given for {asked}")
        r = reach.select(*[F.col("day" if c == "date" else c).alias(f"__{c}") for c in dims], *REACH_MEASURES)
        same = F.lit(True)
        for c in dims:
            same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
        g = g.join(r, same, "left")
        so_far = Window.partitionBy(*dims[1:]).orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
        g = g.select(*[c for c in g.columns if c not in REACH_MEASURES],
                     F.coalesce(F.last("cumulativeReach", True).over(so_far), F.lit(0)).alias("cumulativeReach"),
                     F.last("impressionsFrequencyAverage", True).over(so_far).alias("impressionsFrequencyAverage"))
    return g.select(*[F.col(DIMENSIONS[c]).alias(c) if c in DIMENSIONS else F.col(c) if c in REACH_MEASURES
                      else F.expr(measures[c].sql).alias(c) for c in spec.columns])


def run_reports(traffic: DataFrame, attributed: DataFrame, specs: Mapping[str, ReportSpec], folder: str,
                viewable_at: int = 10, five_seconds_at: int = 20) -> dict[str, DataFrame]:
    """R1, many declared reports from one scan of the events: a lattice of grains.

    The finest facts of all specs are summed once and written under ``folder``
    (shared by driver and executors); every other grain is summed from the
    smallest written grain that holds its dimensions and written in turn, so
    reports of one grain share it.  Runs one job a grain.

    Traffic knows no bought item: grains with one come from the credited part of
    the facts, all others from both.  Reach is no sum and has no place here."""
    spark = traffic.sparkSession
    wanted = list(dict.fromkeys(b for s in specs.values() for b in s.needs()))
    reach = [c for s in specs.values() for c in s.columns if c in REACH_MEASURES]
    if reach:
        raise KeyError(f"not a sum: {reach}")
    need = {name: frozenset([*s.dims(), *[DIMENSIONS.get(c, c) for c in s.filters]]) for name, s in specs.items()}
    dims = sorted(frozenset().union(*need.values()))
    views = ["by_view"] if "by_view" in attributed.columns else []
    a = attributed_sums(attributed, ["click_day", *dims, *views], money=MONEY, wanted=wanted).withColumnRenamed("click_day", "date")
    t = traffic_sums(traffic, [d for d in dims if d != BOUGHT], wanted, viewable_at, five_seconds_at)
    measures = _measure_types(wanted, t, a)
    if BOUGHT in dims:
        t = t.withColumn(BOUGHT, F.lit(None).cast(a.schema[BOUGHT].dataType))
    won = F.when(F.col("by_view"), F.lit("view")).otherwise(F.lit("click")) if views else F.lit("click")
    facts = union_facts(t.withColumn("source", F.lit("traffic")), a.withColumn("source", won).drop(*views), measures)

    def stored(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder.rstrip('/')}/{name}")

    finest = stored(facts, "facts")
    # a grain and where its rows come from: all, or what clicks (and views) won of bought items
    node = {name: (need[name], ("click", "view") if s.display else ("click",)) if BOUGHT in need[name] else (need[name], None)
            for name, s in specs.items()}
    made: dict[tuple, DataFrame] = {}
    for i, (grain, sources) in enumerate(sorted(set(node.values()), key=lambda g: (-len(g[0]), sorted(g[0]), str(g[1])))):
        finer = [g for g in made if grain < g[0] and g[1] == sources]
        if finer:
            src = made[min(finer, key=lambda g: (len(g[0]), sorted(g[0])))]
        else:
            src = finest.where(F.col("source").isin(*sources)) if sources else finest
        made[grain, sources] = stored(_summed(src, ["date", *sorted(grain)], measures), f"grain{i}")
    return {name: run_report(made[node[name]], s, summed=need[name] == frozenset(s.dims())) for name, s in specs.items()}


# ----------------------------------------------------------------------------
# R5 new-to-brand, R6 funnel, R7 cumulative reach, R8 slot share

def flag_new_to_brand(purchases: DataFrame, user: str = "user_id", brand: str = "brand", ts: str = "ts") -> DataFrame:
    """Adds ``ntb``: the user's first purchase of that brand (in the data).  A
    purchase without a user is never known to be the first."""
    first = purchases.where(F.col(user).isNotNull()).groupBy(user, F.col(brand).alias("__brand")).agg(F.min(ts).alias("__first"))
    first = first.withColumnRenamed(user, "__user")
    p = purchases.join(first, (F.col(user) == F.col("__user")) & F.col(brand).eqNullSafe(F.col("__brand")), "left")
    return p.withColumn("ntb", F.coalesce(F.col(ts) == F.col("__first"), F.lit(False))).drop("__user", "__brand", "__first")


def new_to_brand(purchases: DataFrame, user: str = "user_id", brand: str = "brand", ts: str = "ts",
                 dims: Sequence[str] = ("day", "campaign_id")) -> DataFrame:
    """A purchase is new-to-brand when it is the user's first purchase of
    that brand (in the data).  Counts, sales, units and percentages."""
    p = flag_new_to_brand(purchases, user, brand, ts)
    g = p.groupBy(*dims).agg(
        F.count(F.lit(1)).alias("purchases"),
        F.count_if("ntb").alias("newToBrandPurchases"),
        F.sum(F.when(F.col("ntb"), F.col("sales"))).cast("double").alias("newToBrandSales"),
        F.sum("sales").cast("double").alias("sales"),
        F.sum(F.when(F.col("ntb"), F.col("units"))).alias("newToBrandUnitsSold"),
        F.sum("units").alias("unitsSold"))
    return g.select("*",
                    (F.try_divide(F.col("newToBrandPurchases") * 100.0, F.col("purchases"))).alias("newToBrandPurchasesPercentage"),
                    (F.try_divide(F.col("newToBrandSales") * 100.0, F.col("sales"))).alias("newToBrandSalesPercentage"),
                    (F.try_divide(F.col("newToBrandUnitsSold") * 100.0, F.col("unitsSold"))).alias("newToBrandUnitsSoldPercentage"))


def view_funnel(impressions: DataFrame, viewable_at: int, five_seconds_at: int, progress: str = "progress",
                dims: Sequence[str] = ("day", "campaign_id"), steps: Mapping[str, int] = FUNNEL_STEPS) -> DataFrame:
    """Impressions -> quartiles -> complete, viewability and 5-second
    view rates, view click-through.  ``progress`` is percent watched;
    ``viewable_at`` and ``five_seconds_at`` are the percent that stand for a
    viewable impression and for five seconds (they depend on the ad's length)."""
    p = F.col(progress)
    aggs = [F.count(F.lit(1)).alias("impressions")]
    aggs += [F.count_if(p >= t).alias(n) for n, t in steps.items()]
    aggs += [F.count_if(p >= viewable_at).alias("viewableImpressions"),
             F.count_if(p >= five_seconds_at).alias("video5SecondViews"),
             F.count_if(F.col("event_type") == "click").alias("clicks")]
    g = impressions.groupBy(*dims).agg(*aggs)
    return g.select("*",
                    F.try_divide(F.col("viewableImpressions").cast("double"), F.col("impressions").cast("double")).alias("viewabilityRate"),
                    F.try_divide(F.col("video5SecondViews").cast("double"), F.col("impressions").cast("double")).alias("video5SecondViewRate"),
                    F.try_divide(F.col("clicks").cast("double"), F.col("viewableImpressions").cast("double")).alias("viewClickThroughRate"))


def cumulative_reach(impressions: DataFrame, user: str = "user_id", day: str = "day",
                     key: Sequence[str] = ("campaign_id",)) -> DataFrame:
    """Reach to date (distinct users seen up to each day) and average
    frequency (impressions to date / reach to date), exact: each user counts
    on its first day, then running sums over a campaign's days.  Impressions
    without a user count as impressions only."""
    first = impressions.where(F.col(user).isNotNull()).groupBy(*key, user).agg(F.min(day).alias(day))
    new = first.groupBy(*key, day).agg(F.count(F.lit(1)).alias("newUsers"))
    imp = impressions.groupBy(*key, day).agg(F.count(F.lit(1)).alias("impressions"))
    d = imp.join(new, [*key, day], "left").fillna(0, ["newUsers"])
    w = Window.partitionBy(*key).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(*key, day, "impressions", F.sum("newUsers").over(w).alias("cumulativeReach"),
                 F.sum("impressions").over(w).alias("__cum_imp"))
    return d.select(*key, day, "impressions", "cumulativeReach",
                    F.try_divide(F.col("__cum_imp").cast("double"), F.col("cumulativeReach").cast("double"))
                    .alias("impressionsFrequencyAverage"))


def slot_share(impressions: DataFrame, slot: str = "placement", dims: Sequence[str] = ("day",),
               key: str = "campaign_id") -> DataFrame:
    """A campaign's impressions / all impressions of its slot and day.
    Slot totals are an aggregate joined back (one row per slot-day)."""
    g = impressions.groupBy(*dims, slot, key).agg(F.count(F.lit(1)).alias("impressions"))
    tot = g.groupBy(*[F.col(c).alias(f"__{c}") for c in (*dims, slot)]).agg(F.sum("impressions").alias("__slot"))
    same = F.lit(True)
    for c in (*dims, slot):
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return g.join(tot, same).select(
        *dims, slot, key, "impressions",
        F.try_divide(F.col("impressions").cast("double"), F.col("__slot").cast("double")).alias("impressionShare"))


# ----------------------------------------------------------------------------
# R9 market insight, R11 repeat purchase, R12 search-term ranks,
# R13 item-day facts, R14 omnichannel star

MARKET_METRICS = ["dollar_volume", "units", "dollar_volume_yago", "units_yago", "dollar_volume_yago_change",
                  "units_yago_change", "dollar_volume_share"]


def market_insight(sales: DataFrame, dims: Sequence[str], period: str = "period", months_back: int = 12,
                   tasks: int | None = None) -> DataFrame:
    """Value and units per period (a day or the first day of a month) and
    dimensions, the same ``months_back`` months before, change, and share of the
    period's value.

    The year-ago values come from a window over the periods of the same
    dimensions, whose frame is the one shifted period (NULL when it has no row);
    the period's total from an aggregate joined back, so no window holds a whole
    period.  NULL dimensions are values.

    ``tasks``: for grains so fine that summing before the shuffle saves little,
    the sales go once, by their dimensions, to so many tasks that sum them and
    look back; else they are summed first."""
    s = sales if tasks is None else sales.repartition(tasks, *dims)
    g = s.groupBy(period, *dims).agg(F.sum("value").alias("dollar_volume"), F.sum("units").alias("units"))
    # both sums in one value: the totals read the same columns as the rows, so both share the sales' shuffle
    total = g.groupBy(F.col(period).alias("__of")).agg(F.array(
        F.sum("dollar_volume").cast("double"), F.sum(F.col("units").cast("double"))).alias("__tot"))
    by = ", ".join(f"`{c}`" for c in dims)
    back = f"INTERVAL '{months_back}' MONTH PRECEDING"
    ago = (f"CASE WHEN `{period}` IS NOT NULL THEN max({{}}) OVER (PARTITION BY {by} ORDER BY `{period}` "
           f"RANGE BETWEEN {back} AND {back}) END")
    g = g.select("*", F.expr(ago.format("dollar_volume")).alias("dollar_volume_yago"), F.expr(ago.format("units")).alias("units_yago"))
    j = g.join(F.broadcast(total), F.col(period).eqNullSafe(F.col("__of")), "left")  # one row a period
    dv, u = F.col("dollar_volume").cast("double"), F.col("units").cast("double")
    dvy, uy = F.col("dollar_volume_yago").cast("double"), F.col("units_yago").cast("double")
    return j.select(period, *dims, dv.alias("dollar_volume"), u.alias("units"), dvy.alias("dollar_volume_yago"),
                    uy.alias("units_yago"), F.try_divide(dv - dvy, dvy).alias("dollar_volume_yago_change"),
                    F.try_divide(u - uy, uy).alias("units_yago_change"),
                    F.try_divide(dv, F.col("__tot")[0]).alias("dollar_volume_share"))


def repeat_purchase(orders: DataFrame, item: str, customer: str, order: str, revenue: str,
                    period: str = "period", tasks: int | None = None) -> DataFrame:
    """Per item and period: orders, unique customers, share of
    customers who ordered more than once, revenue from those customers and
    its share of revenue.

    Rows are summed by order, then by customer, then by slices of an item's
    customers (``SLICES``, so that an item that everybody buys is many tasks' work) and
    last by item, in ``tasks`` tasks each time (the session's shuffle partitions
    if not given).  Almost every row is a group of its own until the last sum, so
    nothing is summed before a shuffle.  Orders that come partitioned by ``order``
    (from a join, say) are not shuffled for the first sum."""
    n = tasks or int(orders.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    per_o = orders.groupBy(period, item, customer, order).agg(F.sum(revenue).alias("__rev"))
    per_o = per_o.withColumn("__slice", F.pmod(F.xxhash64(customer), F.lit(SLICES))).repartition(n, period, item, "__slice")
    per_c = per_o.groupBy(period, item, "__slice", customer).agg(F.count(order).alias("__orders"), F.sum("__rev").alias("__rev"))
    again = F.col("__orders") > 1
    part = per_c.groupBy(period, item, "__slice").agg(
        F.sum("__orders").alias("__orders"), F.count(F.lit(1)).alias("__customers"), F.count_if(again).alias("__repeat"),
        F.sum(F.when(again, F.col("__rev"))).alias("__rep_rev"), F.sum("__rev").alias("__rev"))
    g = part.repartition(n, period, item).groupBy(period, item).agg(
        F.sum("__orders").alias("ORDERS"), F.sum("__customers").alias("UNIQUECUSTOMERS"), F.sum("__repeat").alias("__repeat"),
        F.sum("__rep_rev").alias("__rep_rev"), F.sum("__rev").alias("__rev"))
    return g.select(period, item, "ORDERS", "UNIQUECUSTOMERS",
                    F.try_divide(F.col("__repeat") * 100.0, F.col("UNIQUECUSTOMERS")).alias("REPEATCUSTOMERSPCTTOTAL"),
                    F.coalesce(F.col("__rep_rev"), F.lit(0).cast(g.schema["__rep_rev"].dataType)).cast("double")
                    .alias("REPEATPURCHASEREVENUE"),
                    F.try_divide(F.coalesce(F.col("__rep_rev"), F.lit(0)).cast("double") * 100.0,
                                 F.col("__rev").cast("double")).alias("REPEATPURCHASEREVENUEPCTTOTAL"))


def rank_desc(df: DataFrame, value: str, out: str) -> DataFrame:
    """SQL ``RANK() OVER (ORDER BY value DESC)`` without a single-partition
    window over all rows: rank = 1 + rows with a larger value, from a
    histogram of the values (one row per distinct value)."""
    hist = df.groupBy(value).agg(F.count(F.lit(1)).alias("__n"))
    w = Window.orderBy(F.col(value).desc()).rowsBetween(Window.unboundedPreceding, -1)
    hist = hist.select(value, (F.coalesce(F.sum("__n").over(w), F.lit(0)) + 1).alias(out))
    return df.join(hist, value)


def search_term_ranks(clicks: DataFrame, term: str = "searchTerm", item: str = "clickedAsin") -> DataFrame:
    """Per (term, item): frequency rank of the term, the item's click
    share and conversion share within the term, and its rank by clicks
    within the term.

    The rank within a term comes from a histogram of its items' click counts
    (at most about sqrt(2 x clicks) rows a term), so a hot term's items are never
    in one task.  A NULL term is a term."""
    g = clicks.groupBy(term, item).agg(F.count(F.lit(1)).alias("__clicks"),
                                       F.count_if(F.col("converted")).alias("__conv"))
    t = g.groupBy(F.col(term).alias("__term")).agg(F.sum("__clicks").alias("__term_clicks"), F.sum("__conv").alias("__term_conv"))
    t = rank_desc(t, "__term_clicks", "searchFrequencyRank")
    h = g.groupBy(F.col(term).alias("__t"), F.col("__clicks").alias("__c")).agg(F.count(F.lit(1)).alias("__n"))
    more = Window.partitionBy("__t").orderBy(F.col("__c").desc()).rowsBetween(Window.unboundedPreceding, -1)
    h = h.select("__t", "__c", (F.coalesce(F.sum("__n").over(more), F.lit(0)) + 1).cast("int").alias("clickShareRank"))
    j = (g.join(t, F.col(term).eqNullSafe(F.col("__term")))
         .join(h, F.col(term).eqNullSafe(F.col("__t")) & (F.col("__clicks") == F.col("__c"))))
    return j.select(term, item, F.col("searchFrequencyRank").cast("int").alias("searchFrequencyRank"), "clickShareRank",
                    F.try_divide(F.col("__clicks").cast("double"), F.col("__term_clicks").cast("double")).alias("clickShare"),
                    F.try_divide(F.col("__conv").cast("double"), F.col("__term_conv").cast("double")).alias("conversionShare"))


QUANTILES = {"P70": 0.7, "P80": 0.8, "P90": 0.9}


def exact_percentiles(df: DataFrame, key: str, value: str, quantiles: Mapping[str, float] = QUANTILES) -> DataFrame:
    """Continuous percentiles (linear interpolation between order statistics,
    as ``percentile_cont``) per key: one aggregate, combined map-side.  Of whole numbers
    and tenths as quantiles the result is exact; it is rounded to six digits."""
    qs = ", ".join(str(x) for x in quantiles.values())
    g = df.groupBy(key).agg(F.expr(f"percentile(`{value}`, array({qs}))").alias("__q"))
    return g.select(key, *[F.round(F.col("__q")[i], 6).alias(n) for i, n in enumerate(quantiles)])


def item_day_facts(lines: DataFrame, item: str, day: str) -> DataFrame:
    """Per item and day: ordered units and revenue, shipped cost,
    net margin; forecast quantiles P70/P80/P90 of the item's daily units
    (exact continuous percentiles over its days)."""
    d = lines.groupBy(item, day).agg(F.sum("units").alias("orderedUnits"), F.sum("revenue").alias("orderedRevenue"),
                                     F.sum("cogs").alias("shippedCogs"))
    d = d.withColumn("netPpm", F.try_divide((F.col("orderedRevenue") - F.col("shippedCogs")).cast("double"),
                                            F.col("orderedRevenue").cast("double")))
    q = exact_percentiles(d, item, "orderedUnits")
    q = q.withColumnRenamed(item, "__item")
    return d.join(q, F.col(item).eqNullSafe(F.col("__item"))).select(item, day, "orderedUnits", F.col("orderedRevenue").cast("double").alias("orderedRevenue"),
                                  F.col("shippedCogs").cast("double").alias("shippedCogs"), "netPpm", *QUANTILES)


def omni_star(sales: DataFrame, items: DataFrame, stores: DataFrame, item_key: str, store_key: str,
              dims: Sequence[str], measures: Mapping[str, str]) -> DataFrame:
    """Sales feed joined to the item and store snapshots (dimension
    tables; AQE broadcasts them when their measured size is small), summed
    by the requested dimensions."""
    j = sales.join(items, item_key).join(stores, store_key)
    return j.groupBy(*dims).agg(*[F.sum(src).alias(out) for out, src in measures.items()])
