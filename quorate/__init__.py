"""Multi-source entity consolidation and data-quality gating on Spark."""
