"""The queries of ``__spark_entry__.py`` and the SQL each is compared with."""
