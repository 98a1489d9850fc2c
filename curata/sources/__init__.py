"""Sources, sinks and materialisation."""

from curata.sources.tables import TABLES, load_table
from curata.sources.encounters import encounters, ENCOUNTERS_CTES, with_encounters
from curata.sources.files import read_csv, source_profile, partition_count, try_cast_columns
from curata.sources.sinks import write_table, persist, checkpoint_table

__all__ = [
    "TABLES", "load_table", "encounters", "ENCOUNTERS_CTES", "with_encounters",
    "read_csv", "source_profile", "partition_count", "try_cast_columns", "write_table", "persist", "checkpoint_table",
]
