"""Column builders (scalar expressions).  All are native Spark expressions,
so they stay inside whole-stage codegen; none is a Python UDF."""
