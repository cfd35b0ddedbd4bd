"""Rating analytics and recommendation lists as plain Spark DataFrame and Spark ML jobs."""
