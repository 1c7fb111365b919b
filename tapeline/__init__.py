"""Market-bar signals and dated-publication intelligence as Spark DataFrame operators."""
