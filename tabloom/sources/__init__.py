"""Reading and writing tables."""

from .files import (  # noqa: F401
    csv_scan_inferred,
    csv_scan_renamed,
    csv_scan_typed,
    csv_sink,
    parquet_scan,
    preview_shape,
    stage_snapshot,
)
