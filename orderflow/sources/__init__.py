"""Reading feeds and the metrics log, staging intermediate results, publishing tables."""
