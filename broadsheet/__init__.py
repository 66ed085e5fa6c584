"""Content analytics on Spark: articles, versions, links, trends and search."""
