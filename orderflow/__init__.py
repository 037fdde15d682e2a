"""Order analytics on PySpark DataFrames: from raw feeds to trusted daily and regional revenue."""
