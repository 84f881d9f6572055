"""The queries this library answers, over a folder of the given tables.

``spark_queries`` holds them as DataFrame programs and ``duckdb_oracle`` the
same results as SQL for an independent check.
"""
