"""The checked queries: derived audit data, Spark queries and their SQL."""
