"""Sources and sinks: delimited text, bag-of-words lyrics, Parquet."""
