"""Column expressions used inside the operators (native Catalyst only)."""

from playlens.functions.scalar import (  # noqa: F401
    affinity, cohort_item_score, epoch_ts, jaccard, lift, link_key, release_year,
    safe_cast, safe_date, safe_ts, slug, unify_tags,
)
from playlens.functions.nested import (  # noqa: F401
    arr_or_empty, fill_defaults, first_where, pluck, pluck_where, select_as,
)
