"""Model training and scoring on Spark ML."""
