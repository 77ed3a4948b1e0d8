"""Plans: the stand-in frame over the driver's tables and the end-to-end regression job."""
