"""quillgate: a Spark-native engine for building and checking hardware-design corpora."""
