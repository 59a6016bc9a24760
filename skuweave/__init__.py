"""Product-data integration and entity matching as Spark DataFrame operators."""
