"""docwright: document quality and curation as Spark DataFrame operators."""
