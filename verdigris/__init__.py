"""A data-quality rules engine and stratified audit sampler on Spark."""
