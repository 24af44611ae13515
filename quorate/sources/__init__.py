"""Scans: entity lists, landing tables, catalog tables and SQL."""

from quorate.sources.entities import entity_list, in_file_order, read_entities, read_entity_file
from quorate.sources.landing import LANDING_SCHEMA, read_landing, route_by_content_type, split_by_status
from quorate.sources.staging import new_folder, stage, staging_root
from quorate.sources.tables import scan

__all__ = [
    "LANDING_SCHEMA",
    "entity_list",
    "in_file_order",
    "new_folder",
    "read_entities",
    "read_entity_file",
    "read_landing",
    "route_by_content_type",
    "scan",
    "split_by_status",
    "stage",
    "staging_root",
]
