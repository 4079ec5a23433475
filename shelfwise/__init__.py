"""PySpark library for document corpora, retrieval, batch question answering and monitoring."""
