"""All queries of the catalog: importing a module of queries registers them."""

from cardmill.catalog import upkeep  # noqa: F401
from cardmill.catalog.queries import QUERIES  # noqa: F401
