"""A Spark-native engine for preparing and auditing speech and text training corpora."""
