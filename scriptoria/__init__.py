"""scriptoria: text, catalogue and corpus analytics expressed as Spark DataFrame jobs."""
