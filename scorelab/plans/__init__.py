"""Named compositions: stages, reports, chart datasets, models."""
