"""Evidence-checked extraction analytics on PySpark."""
