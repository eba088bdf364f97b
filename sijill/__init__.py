"""Document-corpus analytics engine built on Spark DataFrames."""
