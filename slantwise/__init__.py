"""Text class scoring and group reporting as Spark DataFrame operators."""
