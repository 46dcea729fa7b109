"""fieldlens: land-use change detection and evidence jobs on Spark DataFrames."""
