"""Every operator and report of the library on the driver's tables, each next to an equivalent SQL query."""

from catalogue import (  # noqa: F401  (importing a module registers its queries)
    aggregates,
    calendar,
    checks,
    joins,
    reports,
    reshaping,
    scalars,
    tables,
    windows,
)
from catalogue.base import QUERIES, SQL  # noqa: F401
