"""gleaner: web-crawl and user-log analytics as Spark DataFrame plans."""
