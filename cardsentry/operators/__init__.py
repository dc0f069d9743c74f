"""DataFrame operators: facts, verdicts, rule tables, rollups, feedback, quality."""
