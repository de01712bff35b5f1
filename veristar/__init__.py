"""veristar: review-integrity analytics on Spark DataFrames."""
