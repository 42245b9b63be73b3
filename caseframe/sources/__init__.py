"""Readers, writers and the working folder."""

from caseframe.sources.layouts import file_headers, layouts, read_lines
from caseframe.sources.publishing import manifest, publication, published
from caseframe.sources.readers import (
    input_report,
    load_uncleaned,
    load_uncleaned_predictions,
    read_clean,
    read_clean_csv,
    read_model,
    read_parquet,
    read_predictions_csv,
    read_raw,
    read_raw_lines,
    read_rows,
)
from caseframe.sources.working import materialise, new_path
from caseframe.sources.writers import (
    unsorted_writes,
    write_clean,
    write_csv,
    write_model,
    write_predictions,
)

__all__ = [
    "file_headers",
    "input_report",
    "layouts",
    "read_lines",
    "load_uncleaned",
    "load_uncleaned_predictions",
    "manifest",
    "materialise",
    "new_path",
    "publication",
    "published",
    "read_clean",
    "read_clean_csv",
    "read_model",
    "read_parquet",
    "read_predictions_csv",
    "read_raw",
    "read_raw_lines",
    "read_rows",
    "unsorted_writes",
    "write_clean",
    "write_csv",
    "write_model",
    "write_predictions",
]
