"""cohorta: cohort features, cleaning, resampling, models and evaluation as Spark jobs."""
