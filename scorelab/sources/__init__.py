"""Scans and sinks: survey CSV, Parquet tables, CSV reports, JSON records."""

from scorelab.sources.reports import read_metrics, read_report, write_metrics, write_report
from scorelab.sources.split_csv import read_split_csv
from scorelab.sources.survey_csv import read_survey_csv, write_survey_csv
from scorelab.sources.tables import (
    read_optional_table,
    read_table,
    register_table,
    select_available,
    write_table,
)
from scorelab.sources.versions import Facts, read_version, table_facts, write_version

__all__ = [
    "read_metrics", "read_report", "write_metrics", "write_report",
    "read_split_csv", "read_survey_csv", "write_survey_csv",
    "read_optional_table", "read_table", "register_table", "select_available", "write_table",
    "Facts", "read_version", "table_facts", "write_version",
]
