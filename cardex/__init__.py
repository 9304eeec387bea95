"""Contact analytics over web archives and text tables, as Spark DataFrame operators."""
