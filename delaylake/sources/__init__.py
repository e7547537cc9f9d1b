"""Raw files, stage tables and report files."""
