"""Web-search and article data as Spark tables: search, merge, extract, research."""
