"""Parameters of a crawl and the catalogue of queries."""
