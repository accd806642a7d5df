"""harrow: harvested-catalogue analytics and corpus preparation on Spark DataFrames."""
