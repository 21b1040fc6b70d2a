"""Table plans: commit log, checkpoints, incremental reads, maintenance, catalog."""
