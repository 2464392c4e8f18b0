"""Building blocks: DataFrame in, DataFrame out."""
