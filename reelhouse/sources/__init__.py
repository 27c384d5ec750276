"""Sources: raw CSV landing (bronze) and raw relations derived from test tables."""

from reelhouse.sources.csv import land_raw, read_raw_csv, source_file_stats  # noqa: F401
from reelhouse.sources.fixtures import raw_relations  # noqa: F401
