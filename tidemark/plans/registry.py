"""All registered queries and their DuckDB oracle SQL."""

from __future__ import annotations

from tidemark.plans import catalog_lake, oracle_lake

LAKE_KEYS = [
    "raw_json_read", "partition_range_read", "partition_from_path", "export_json_roundtrip",
    "safe_cast", "reject_reason", "valid_rows", "quarantine_rows", "outcome_profile", "breaker_decision",
    "bronze_to_silver", "dedup_within_day", "current_state", "affected_dates", "gold_rebuild",
    "silver_to_gold", "assert_gold_counts", "backfill_equals_daily", "idempotent_rerun",
    "idempotent_overwrite", "compact_files", "run_metrics", "truth_daily", "reconcile_full_outer",
    "reconcile_summary", "spanning_orders", "reconcile_last_day", "emptied_dates", "volume_gates", "gen_universe", "gen_events", "gate_results", "gold_freshness", "daily_run",
]


def spark_queries() -> dict:
    q = {k: getattr(catalog_lake, k) for k in LAKE_KEYS}
    for mod in _more_modules():
        q.update(mod.QUERIES)
    return q


def oracle_queries() -> dict:
    o = {k: v for k, v in oracle_lake.oracle().items() if k in LAKE_KEYS}
    for mod in _more_modules():
        o.update(mod.ORACLE)
    return o


def _more_modules():
    mods = []
    for name in ("catalog_relational", "catalog_dims", "catalog_upkeep", "catalog_usage", "catalog_stream", "catalog_misc"):
        try:
            mods.append(__import__("tidemark.plans." + name, fromlist=["QUERIES"]))
        except ModuleNotFoundError as e:
            if e.name != "tidemark.plans." + name:
                raise
    return mods
