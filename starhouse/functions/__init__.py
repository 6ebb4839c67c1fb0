"""Column expressions used by the operators (all JVM-side built-ins)."""
from .text import standardized, change_hash  # noqa: F401
from .money import to_money, to_pct, net_amount  # noqa: F401
from .dates import date_key, calendar_columns, as_timestamp  # noqa: F401
