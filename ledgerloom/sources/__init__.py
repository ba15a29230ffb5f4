"""Readers and writers: delimited, fixed-width, XML, Parquet, change feeds, streams."""
