"""Encyclopedia dumps and document collections as Spark DataFrames."""
