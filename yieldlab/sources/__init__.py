"""Sources and sinks: sensor-matrix and label text loaders (file order kept
through a distributed index), Parquet tables and the wide production log."""
