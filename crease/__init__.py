"""Ball-by-ball match analytics on Spark: documents in, star schema, scorecards and careers out."""
