from cohortforge.sources.catalog import blank_is_null, from_frames, from_parquet, from_tables, remembered
from cohortforge.sources.drivers import (
    DX_CODES,
    LAB_RULES,
    LAB_SELECTION,
    MED_SELECTION,
    read_driver,
)
from cohortforge.sources.files import Files
from cohortforge.sources.landing import land
from cohortforge.sources.sinks import TIME_FORMAT, StageStore, write_csv

__all__ = [
    "DX_CODES",
    "Files",
    "LAB_RULES",
    "LAB_SELECTION",
    "MED_SELECTION",
    "StageStore",
    "TIME_FORMAT",
    "blank_is_null",
    "from_frames",
    "from_parquet",
    "from_tables",
    "land",
    "read_driver",
    "remembered",
    "write_csv",
]
