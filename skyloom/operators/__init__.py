"""DataFrame to DataFrame operators, composable through ``DataFrame.transform``."""
