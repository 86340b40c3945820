"""Column-building functions (pure Spark SQL expressions) and small numpy kernels."""
