"""Sources and sinks: raw sales files, warehouse tables, forecast files, driver test tables."""

from tillspark.sources.files import (coerce_numeric, list_tables, load_forecast, load_raw, read_csv,
                                     write_table)

__all__ = ["coerce_numeric", "list_tables", "load_forecast", "load_raw", "read_csv", "write_table"]
