"""DataFrame -> DataFrame operators of the lift workload."""
