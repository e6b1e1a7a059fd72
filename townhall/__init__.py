"""Community-conversation analytics on Spark: DataFrame in, DataFrame out."""
