"""Card-fraud scoring on Spark: parse, per-card facts, verdicts, alerts, batch layer."""
