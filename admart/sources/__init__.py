from admart.sources.fixtures import fixture_sources
from admart.sources.registry import IDENTIFIERS, Sources, conform, physical_name, warehouse_sources
from admart.sources.rejects import accepted, checked, ledger, ledger_counts
from admart.sources.schemas import SCHEMAS
from admart.sources.sinks import as_view, read_sorted, save_sorted, save_table

__all__ = ["IDENTIFIERS", "SCHEMAS", "Sources", "accepted", "as_view", "checked", "conform", "fixture_sources", "ledger",
           "ledger_counts", "physical_name", "read_sorted", "save_sorted", "save_table", "warehouse_sources"]
