"""Sources and sinks: the flat retail CSV, the star-schema binding, writers."""

from ledgerline.sources.star import FACT_COLUMNS, FACT_SQL, bind_fact  # noqa: F401
