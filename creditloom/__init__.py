"""creditloom: credit-risk analytics on Spark DataFrames."""
