"""tidyloom: data preparation and small analytics as Spark DataFrame jobs."""
