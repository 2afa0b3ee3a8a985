"""corpusloom: speech- and text-corpus preparation expressed as Spark plans."""
