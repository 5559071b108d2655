"""Corporate-registry analytics on Spark: DataFrame in, DataFrame out."""
