"""statuta: versioned legal-document analytics on PySpark."""
