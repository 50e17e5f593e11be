"""DataFrame -> DataFrame operators (cohort, quality, profiling, labels, ranks,
evaluation, training, scoring)."""
