"""Monthly customer propensity analytics as Spark DataFrame operators."""
