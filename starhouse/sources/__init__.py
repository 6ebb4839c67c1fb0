"""Sources: bronze schemas, dated CSV batches, driver-table fixtures."""
from .schemas import BRONZE, CUSTOMERS, PRODUCTS, ENTITIES, EntitySpec, STAR  # noqa: F401
from .bronze import batch_glob, read_bronze, write_bronze  # noqa: F401
