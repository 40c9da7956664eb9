"""Entity-directory analytics and corpus preparation on Spark DataFrames."""
