from terrace.sources.csv import MALFORMED, read_csv, read_marked_csv, read_source

__all__ = ["MALFORMED", "read_csv", "read_marked_csv", "read_source"]
