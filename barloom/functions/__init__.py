"""Expressions over ordered bars, and the kernels that Spark SQL has no words for."""
