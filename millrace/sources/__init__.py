"""Sources, sinks and generators."""
