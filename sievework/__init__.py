"""Contact qualification on Spark: contacts, crawled pages and yes/no answers in, scored leads out."""
