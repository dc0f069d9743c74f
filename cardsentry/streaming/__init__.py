"""The scoring job as a stream: remembered cards, micro-batch scoring, sinks."""
