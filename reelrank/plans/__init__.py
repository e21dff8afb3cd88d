"""Named queries over the driver tables and their DuckDB oracle SQL."""

from .queries import QUERIES, flagship  # noqa: F401
from .oracles import ORACLES  # noqa: F401
