"""corpusloom: DataFrame operators for documentation corpora, written for large Spark clusters."""
