"""Text retrieval and link analysis as Spark DataFrame jobs."""
