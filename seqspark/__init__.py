"""seqspark: analysis of families of related sequences on Spark DataFrames."""
