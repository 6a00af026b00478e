"""Full-text document analytics and semantic retrieval on Spark DataFrames."""
