"""Write COVERAGE.md: every SURVEY section-2 id -> implementing function(s),
registered queries (from the registry) and tests that exercise it.

    python tools/coverage_report.py > COVERAGE.md
"""

from __future__ import annotations

import importlib
import os
import re
import sys
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shelfscope.registry import load_all  # noqa: E402

# id -> (description, "module:function" list)
IMPL = {
    "S1": ("gzip JSON report -> rows", ["sources.files:read_report_json", "sources.drift:read_variant_documents"]),
    "S2": ("ORC report", ["sources.files:read_report_orc"]),
    "S3": ("CSV report, skipped rows, file position", ["sources.files:read_report_csv", "sources.splits:CsvFiles", "sources.splits:first_lines"]),
    "S4": ("dispatch on suffix", ["sources.files:read_report"]),
    "S5": ("warehouse table by name", ["sources.files:read_table"]),
    "S6": ("per-country SQL text", ["sources.files:run_country_sql"]),
    "S7": ("latest file by string order", ["sources.files:latest_file"]),
    "S8": ("read every file of a table", ["sources.files:read_all", "sources.splits:first_lines"]),
    "S9": ("files of the latest dd.MM.yy date", ["sources.files:read_latest_dated", "sources.files:latest_dated_paths"]),
    "S10": ("search-terms projection", ["sources.files:read_search_terms", "sources.splits:json_elements"]),
    "S11": ("landed dates and file names", ["sources.files:landed_dates", "sources.files:landed_names"]),
    "S12": ("payload outcome", ["sources.payload:classify_payload"]),
    "P1": ("daily half-open windows", ["operators.planning:daily_windows", "operators.windows:assign_window"]),
    "P2": ("N-day windows, last clipped", ["operators.planning:interval_windows", "operators.windows:assign_window"]),
    "P3": ("look-back dates", ["operators.planning:lookback_dates"]),
    "P4": ("back-fill variant", ["operators.planning:backfill_count"]),
    "P5": ("wanted minus landed", ["operators.planning:missing_dates"]),
    "P6": ("date -> request window", ["operators.planning:period_window"]),
    "P7": ("last Saturday", ["operators.planning:last_saturday"]),
    "P8": ("look-back start", ["operators.planning:lookback_start"]),
    "P9": ("latest available period", ["operators.planning:latest_available", "operators.planning:availability_anchor"]),
    "P10": ("inclusive daily range, reversed rejected", ["operators.planning:daily_dates"]),
    "P11": ("snapshot guard", ["operators.planning:snapshot_is_new"]),
    "P12": ("key batches of 20", ["operators.planning:key_batches", "operators.planning:global_rank"]),
    "P13": ("UK/GB aliasing", ["operators.planning:alias_country"]),
    "F1": ("structs -> dotted columns", ["operators.normalize:flatten_structs", "sources.drift:flatten_variant"]),
    "F2": ("first array element flattened", ["operators.normalize:first_elems_flat"]),
    "F3": ("explode array of struct (outer)", ["operators.normalize:explode_struct"]),
    "F4": ("two-level explode", ["operators.normalize:explode_path"]),
    "F5": ("upper-case (trim) names", ["operators.normalize:upper_columns"]),
    "F6": ("x.amount -> X", ["operators.normalize:normalize_report_names"]),
    "F7": ("x.currencyCode -> X_CURRENCYCODE", ["operators.normalize:normalize_report_names"]),
    "F8": ("*date* -> date", ["operators.normalize:normalize_report_names", "operators.normalize:cast_by_name"]),
    "F9": ("*time* -> timestamp", ["operators.normalize:normalize_report_names"]),
    "F10": ("spaces -> underscores, upper", ["operators.normalize:normalize_report_names"]),
    "F11": ("strip prefixes, later wins", ["operators.normalize:strip_prefix"]),
    "F12": ("union with missing columns", ["operators.normalize:union_missing"]),
    "F13": ("audit columns", ["operators.normalize:with_audit"]),
    "F14": ("missing budget columns = 0", ["operators.normalize:ensure_columns"]),
    "F15": ("sentinel tokens", ["operators.normalize:null_tokens"]),
    "F16": ("rename by mapping", ["operators.normalize:rename_columns"]),
    "F17": ("sorted columns", ["operators.normalize:sort_columns"]),
    "F18": ("column contract", ["operators.normalize:assert_columns"]),
    "F19": ("STARTDATE/ENDDATE", ["operators.normalize:with_period"]),
    "C1": ("product-code extraction", ["functions.cleaning:explode_codes", "functions.cleaning:code_list"]),
    "C2": ("duplicate-id repair", ["functions.cleaning:suffix_duplicate_ids", "functions.cleaning:row_number_bucketed"]),
    "C3": ("wide -> long", ["functions.cleaning:unpivot_dates"]),
    "C4": ("two-row header", ["sources.files:read_two_row_header_csv", "plans.flat_files:sellout_files_long"]),
    "C5": ("drop footer rows", ["functions.cleaning:skip_footer"]),
    "C6": ("embedded header row", ["functions.cleaning:promote_embedded_header"]),
    "C7": ("whole-row dedup", ["plans.flat_files:media_plan"]),
    "C8": ("dedup keep first", ["functions.cleaning:dedup_keep_first"]),
    "C9": ("row sum of *Menge", ["functions.cleaning:sum_suffix"]),
    "C10": ("yyyyMMdd -> ISO, strict", ["functions.cleaning:iso_date"]),
    "C11": ("yyyyMMdd -> ISO, lenient", ["functions.cleaning:iso_date"]),
    "C12": ("numeric coercion, drop failures", ["functions.cleaning:require_numeric", "functions.cleaning:numeric"]),
    "C13": ("NULL -> 0 int", ["functions.cleaning:zero_int"]),
    "C14": ("key not blank", ["functions.cleaning:require_key"]),
    "C15": ("numeric code to text", ["functions.cleaning:code_text"]),
    "C16": ("strip zeros, last 6", ["functions.cleaning:code_right"]),
    "C17": ("value recode", ["functions.cleaning:recode"]),
    "C18": ("dictionary translation", ["functions.cleaning:translate_values"]),
    "C19": ("default column, fixed projection", ["functions.cleaning:project"]),
    "C20": ("CN promotions projection", ["plans.flat_files:promotions_table"]),
    "C21": ("dates to text", ["plans.flat_files:promotions_table"]),
    "C22": ("equality filter + projection", ["operators.setops:distinct_keys"]),
    "C23": ("SQL predicates", ["plans.clean_room:campaign_value"]),
    "C24": ("scalar SQL + run parameters", ["operators.windows:assign_window", "functions.brand:map_ad_type"]),
    "C25": ("free-form date text", ["functions.cleaning:format_date"]),
    "J1": ("report x catalog", ["operators.joins:filter_to_catalog"]),
    "J2": ("fact x brand lookup (multiplying)", ["plans.clean_room:lookup_keys"]),
    "J3": ("left join traffic x conversions", ["plans.clean_room:user_core"]),
    "J4": ("left join flight bounds", ["plans.clean_room:campaign_value"]),
    "J5": ("join back per-user set/path", ["plans.clean_room:ad_type_overlap"]),
    "J7": ("set difference by key", ["operators.planning:missing_dates"]),
    "U1": ("zero-filled UNION ALL", ["operators.setops:union_facts", "operators.setops:zero_fill"]),
    "U2": ("key union then DISTINCT", ["operators.setops:distinct_keys"]),
    "U3": ("append frames", ["operators.setops:append_all"]),
    "U4": ("GROUP BY as DISTINCT", ["plans.clean_room:creative_dims"]),
    "U5": ("sorted list, greatest", ["operators.setops:sorted_dates"]),
    "A1": ("sum of measures", ["functions.sqlexpr:sums"]),
    "A2": ("brand classifier", ["functions.brand:classify_indexed", "functions.brand:classify_brand", "functions.brand:brand_array"]),
    "A3": ("MAX(label) per campaign", ["plans.clean_room:brand_lookup"]),
    "A4": ("reach", ["plans.clean_room:campaign_value", "plans.sketches:reach_of_spans", "plans.sketches:shared_reach"]),
    "A5": ("shoppers", ["plans.clean_room:campaign_value"]),
    "A6": ("orders (conditional count)", ["plans.clean_room:campaign_value"]),
    "A7": ("flight MIN/MAX", ["plans.clean_room:brand_lookup"]),
    "A8": ("sorted distinct collection", ["plans.clean_room:ad_type_overlap"]),
    "A9": ("sorted distinct path", ["plans.clean_room:path_to_purchase"]),
    "A10": ("grouped sum, NULL keys dropped", ["operators.aggregates:sum_drop_null_keys"]),
    "A11": ("filter IN + sums", ["plans.clean_room:subscription_sales"]),
    "A12": ("latest value", ["operators.planning:snapshot_is_new"]),
    "A13": ("ad type code map", ["functions.brand:map_ad_type"]),
    "W1": ("ROW_NUMBER by first impression", ["plans.clean_room:path_to_purchase"]),
    "W2": ("running count", ["functions.cleaning:row_number_bucketed"]),
    "W3": ("duplicated flag", ["functions.cleaning:suffix_duplicate_ids"]),
    "Q1": ("campaign value", ["plans.clean_room:campaign_value"]),
    "Q2": ("ad-type overlap", ["plans.clean_room:ad_type_overlap"]),
    "Q3": ("path to purchase", ["plans.clean_room:path_to_purchase"]),
    "Q4": ("subscription sales", ["plans.clean_room:subscription_sales"]),
    "Q5": ("dated vendor report", ["plans.vendor:vendor_report"]),
    "Q6": ("promotions and coupons", ["plans.vendor:promotions_report", "plans.vendor:coupons_report"]),
    "Q7": ("own search terms", ["plans.vendor:own_search_terms"]),
    "Q8": ("catalog build", ["plans.vendor:build_catalog"]),
    "Q9": ("media plan", ["plans.flat_files:media_plan"]),
    "Q10": ("sell-out long table", ["plans.flat_files:sellout_long", "plans.flat_files:sellout_files_long"]),
    "Q11": ("latest inventory", ["plans.flat_files:latest_inventory", "plans.flat_files:latest_inventory_files"]),
    "Q12": ("market sell-out cleaning", ["plans.flat_files:market_sellout"]),
    "Q13": ("promotions tables", ["plans.flat_files:promotions_table", "plans.flat_files:promotions_media"]),
    "Q14": ("sell-in", ["plans.flat_files:sell_in"]),
    "Q15": ("hero mapping", ["plans.flat_files:hero_mapping"]),
    "R1": ("report spec runner", ["plans.reports:run_report", "plans.reports:run_reports", "plans.reports:ad_facts"]),
    "R2": ("attribution windows", ["plans.reports:attribute", "plans.reports:attribute_views", "plans.reports:last_touch_of"]),
    "R3": ("same / other item split", ["plans.reports:attributed_sums"]),
    "R4": ("CTR, CPC, ACOS, ROAS", ["plans.reports:run_report"]),
    "R5": ("new-to-brand", ["plans.reports:new_to_brand", "plans.reports:flag_new_to_brand"]),
    "R6": ("view funnel", ["plans.reports:view_funnel"]),
    "R7": ("cumulative reach", ["plans.reports:cumulative_reach"]),
    "R8": ("slot impression share", ["plans.reports:slot_share"]),
    "R9": ("market insight", ["plans.reports:market_insight"]),
    "R10": ("market basket -- NOT BUILT (needs all item pairs within an order; see README)", []),
    "R11": ("repeat purchase", ["plans.reports:repeat_purchase"]),
    "R12": ("search-term ranks", ["plans.reports:search_term_ranks", "plans.reports:rank_desc"]),
    "R13": ("item-day facts, quantiles", ["plans.reports:item_day_facts", "plans.reports:exact_percentiles", "plans.inventory:fifo_match",
                                             "plans.inventory:inventory_day_facts"]),
    "R14": ("omnichannel star, incremental vs snapshot", ["plans.reports:omni_star", "sinks:write_by_date", "plans.history:snapshot_history",
                                                                 "plans.history:join_valid"]),
    "K1": ("CSV at a path template", ["sinks:write_report", "sinks:write_by_date"]),
    "K2": ("dated CSV, sorted columns", ["sinks:write_dated", "sinks:write_dated_many"]),
    "K3": ("upload with date from data", ["sinks:upload_with_data_date"]),
    "K4": ("archive to Parquet", ["sinks:archive_csv", "sinks:archive_landed"]),
    "K5": ("workflow log", ["sinks:append_workflow_log", "sinks:latest_status"]),
    "K6": ("plain dated CSV, unsorted", ["sinks:write_report"]),
    "T1": ("landing-folder stream ingest", ["streaming.ingest:start_ingest", "streaming.ingest:start_repull", "streaming.ingest:read_repull"]),
}


def tests_mentioning(fn_names: list[str]) -> list[str]:
    hits = set()
    tdir = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tests")
    for f in sorted(os.listdir(tdir)):
        if not f.endswith(".py"):
            continue
        src = open(os.path.join(tdir, f)).read()
        for m in re.finditer(r"def (test_\w+)\(.*?\):\n(.*?)(?=\ndef |\Z)", src, re.S):
            if any(re.search(rf"\b{re.escape(n)}\b", m.group(2)) for n in fn_names):
                hits.add(f"{f}::{m.group(1)}")
    return sorted(hits)


def called_by(fn, spark) -> set[str]:
    """Library functions that building a query calls."""
    seen: set[str] = set()

    def watch(frame, event, arg):
        if event == "call":
            mod = frame.f_globals.get("__name__", "")
            if mod.startswith("shelfscope."):
                seen.add(f"{mod.removeprefix('shelfscope.')}:{frame.f_code.co_name}")
    sys.setprofile(watch)
    try:
        fn(spark, SF)
    finally:
        sys.setprofile(None)
    return seen


SF = os.environ.get("COVERAGE_SF_DIR", "/root/testdata/sf0.001")


def main() -> None:
    from shelfscope.session import local_session
    reg = load_all()
    spark = local_session(cores=4, shuffle_partitions=4, app="coverage")
    calls = {name: called_by(e.fn, spark) for name, e in reg.items()}
    by_id = defaultdict(list)
    for name, e in reg.items():
        for i in e.ids:
            if not set(IMPL[i][1]) or set(IMPL[i][1]) & calls[name] or not any(":" in f for f in IMPL[i][1]):
                by_id[i].append(name)
    print("# Coverage of SURVEY section 2\n")
    print("Generated by `tools/coverage_report.py`. Implementing functions are checked to exist; a registered query (all have "
          "DuckDB oracles) is listed for an id only if building it calls one of them; the tests are the pytest cases "
          "calling those functions.\n")
    print("| id | operator | implemented by | registered queries | tests |")
    print("|---|---|---|---|---|")
    for i, (desc, fns) in IMPL.items():
        for f in fns:  # verify the function exists
            mod, attr = f.split(":")
            assert hasattr(importlib.import_module(f"shelfscope.{mod}"), attr), f
        tests = tests_mentioning([f.split(":")[1] for f in fns])
        print(f"| {i} | {desc} | {', '.join('`' + f.replace(':', '.') + '`' for f in fns) or '—'} | "
              f"{', '.join('`' + q + '`' for q in by_id.get(i, [])) or '—'} | {', '.join(tests[:3]) or '—'} |")


if __name__ == "__main__":
    main()
