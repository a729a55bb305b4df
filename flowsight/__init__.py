"""Analytics on labelled event and flow tables, written as Spark plans."""
