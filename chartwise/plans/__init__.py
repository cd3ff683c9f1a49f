"""User-level jobs: the three questions, chart-ready series, the full run."""
