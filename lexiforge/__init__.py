"""lexiforge: a Spark-native engine from multilingual text corpora to graded knowledge bases."""
