from gradus.sources.builds import current_term, last_builds, stale_tables, term_changed_tables, term_of
from gradus.sources.tables import append_parts, column_catalog, export_csv, read_tables, replace_table

__all__ = [
    "append_parts",
    "column_catalog",
    "current_term",
    "export_csv",
    "last_builds",
    "read_tables",
    "replace_table",
    "stale_tables",
    "term_changed_tables",
    "term_of",
]
