"""Payment-card analytics as small, parameterised Spark DataFrame operators."""
