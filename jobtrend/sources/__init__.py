"""Readers and writers: observation files (tsv), code tables and the reporting
month (codes), fact scans (scan), report sinks (sinks), and the mapping of the
generated test tables onto the employment shape (fixture)."""
