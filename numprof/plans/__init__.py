"""Physical-placement helpers, end-to-end jobs and the query registry."""
