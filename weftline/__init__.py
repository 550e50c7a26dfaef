"""weftline: a Spark-native engine for property graphs held in DataFrames."""
