"""The ten publishing pipelines."""
