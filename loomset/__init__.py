"""Text dataset curation and retrieval analytics as Spark DataFrame operators."""
