"""Agent-evaluation analytics as Spark DataFrame operators."""
