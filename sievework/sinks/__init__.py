"""Writers for results, skipped contacts, requests and the cache."""
