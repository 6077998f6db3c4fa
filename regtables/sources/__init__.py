"""Sources: files and document pages read as DataFrames."""
