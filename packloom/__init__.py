"""packloom: asset-batch planning, validation and corpus preparation on Spark DataFrames."""
