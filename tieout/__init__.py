"""Data-correctness jobs for tables that carry money, as Spark DataFrame transforms."""
