"""The analytics operators: DataFrame in, DataFrame out."""
