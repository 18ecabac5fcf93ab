"""periodload: incremental loads of date-partitioned tables on Spark.

Given a delta DataFrame, a target table, a column contract and a day or month
granularity, replace or merge exactly the periods the delta touches, in one
distributed job, leaving every other period as it was.
"""

from .functions.delta import (
    between_changes,
    between_dates,
    first_run_switch,
    latest_per_key,
    lookback_days,
    lookback_months,
)
from .functions.periods import local_date, period_end, period_label, period_of, truncate
from .operators.contract import (
    ContractError,
    check_contract,
    contract_diff,
    key_diagnostics,
    null_violations,
    typed_projection,
)
from .operators.exchange import delete_insert_content, heavy_keys, merge_content, overwrite_content
from .operators.layout import distribute_for_write, replicated_read
from .operators.partitions import (
    delta_window,
    layout_label,
    list_layout,
    missing_periods,
    out_of_range_rows,
    partition_inventory,
    period_bounds,
    range_layout,
    touched_periods,
    validate_periods,
)
from .operators.snapshot import snapshot_changes, snapshot_merge
from .plans.load import LoadError, LoadResult, first_load, full_build, plan_load, prepare_delta, run
from .sources.staging import sweep_staging
from .sources.tables import TargetError, existing_periods
from .spec import ListLayout, LoadSpec, RangeBounds, RangeLayout, SpecError

__all__ = [n for n in dir() if not n.startswith("_")]
