"""A Spark-native engine that turns overlapping listings from many sources into one trustworthy table."""
