"""docrel: evidence-backed product tables from semi-structured documents, in PySpark."""
