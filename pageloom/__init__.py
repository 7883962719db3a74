"""pageloom: web-content analytics as Spark DataFrame plans."""
