"""Files, workbooks and catalog tables: what the jobs read from and write to."""
