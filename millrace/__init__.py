"""Event analytics and warehouse loading, written as Spark DataFrame operators."""
