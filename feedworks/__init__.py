"""Feed standardisation on Spark: messy delimited files to clean, typed, canonical tables."""

from feedworks.functions.transforms import register_transform
from feedworks.operators.canonical import build_gold_customers, build_gold_transactions, keep_latest
from feedworks.operators.quality import (
    enrich_transactions,
    orphan_transactions,
    quarantine_summary,
    reason_counts,
    row_balance,
    top_reasons,
)
from feedworks.operators.refine import refine_entity
from feedworks.plans.stages import (
    gold_table,
    ingest_client_entity,
    main,
    quarantine_report,
    run_curate,
    run_ingest,
    run_refine,
)
from feedworks.sources.delimited import read_raw
from feedworks.sources.entities import CanonicalEntity, register_entity
from feedworks.sources.spec import check_configs, list_client_ids, load_client_config, load_configs
from feedworks.sources.tables import Retention, ensure_schema, read_table, write_table

__all__ = [
    "CanonicalEntity",
    "Retention",
    "build_gold_customers",
    "build_gold_transactions",
    "check_configs",
    "ensure_schema",
    "enrich_transactions",
    "gold_table",
    "ingest_client_entity",
    "keep_latest",
    "list_client_ids",
    "load_client_config",
    "load_configs",
    "main",
    "orphan_transactions",
    "quarantine_report",
    "quarantine_summary",
    "read_raw",
    "read_table",
    "reason_counts",
    "refine_entity",
    "register_entity",
    "register_transform",
    "row_balance",
    "run_curate",
    "run_ingest",
    "run_refine",
    "top_reasons",
    "write_table",
]
