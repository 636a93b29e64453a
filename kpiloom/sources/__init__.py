from kpiloom.sources.batch import (  # noqa: F401
    BatchFailed, Drops, raise_on_failure, read_history, run_batch, run_history, run_metadata)
from kpiloom.sources.incremental import changed_days, on_days, read_days, refresh_days  # noqa: F401
from kpiloom.sources.sheets import scan_block_sheet, scan_plan_sheet  # noqa: F401
from kpiloom.sources.sinks import json_records, write_csv, write_json_doc  # noqa: F401
from kpiloom.sources.tables import (  # noqa: F401
    category_census, coerce_dates, optional_source, scan_csv, scan_table, source_fallback, union_sources)
