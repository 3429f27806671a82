"""Fund-flow and redemption-risk analytics as composable Spark DataFrame operators."""
