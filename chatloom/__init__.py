"""chatloom: chat-data curation and model evaluation as Spark DataFrame jobs."""
