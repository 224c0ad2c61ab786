"""Customer-risk analytics and document question answering as Spark jobs."""
