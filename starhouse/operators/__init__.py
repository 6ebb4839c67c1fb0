"""DataFrame -> DataFrame operators of the retail model."""
from .keys import assign_dense_key  # noqa: F401
from .silver import silver_orders, silver_order_items  # noqa: F401
from . import scd2, gold, quality, audit  # noqa: F401
