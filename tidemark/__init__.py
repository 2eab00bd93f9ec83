"""Change events in, trusted analytics tables out, on Spark DataFrames."""
