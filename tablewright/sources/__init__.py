"""Where tables come from: files, catalog tables, external databases, generators."""
