"""All registered queries and oracle SQL (importing the query modules)."""

from playlens.plans import queries2, queries3  # noqa: F401  (they register theirs)
from playlens.plans.queries import ORACLE, QUERIES  # noqa: F401
