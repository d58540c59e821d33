"""Set-at-a-time operators: DataFrame in, DataFrame out."""
