"""Sinks: versioned publish, SCD2 store, idempotent append, star tables."""
from .versioned import VersionedTable, CommitLog  # noqa: F401
from .scd2_store import Scd2Store  # noqa: F401
from .transactions import append_new, unseen, read_transactions  # noqa: F401
from .star import create_star, load_table, verify_load, export_dim, table_ddl  # noqa: F401
