from strata.operators.arrays import explode_aligned  # noqa: F401
from strata.operators.ranges import ranged_positions, ranged_rolling  # noqa: F401
from strata.operators.windows import (  # noqa: F401
    latest_per_key,
    latest_snapshot,
    rank_within,
    rolling_rows,
)
