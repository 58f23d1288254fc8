"""Where tables go: files, catalog tables and views, a place for rejected rows."""
