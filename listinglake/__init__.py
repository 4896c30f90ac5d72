"""listinglake — consolidation of company and job-listing feeds as Spark DataFrame jobs."""

__version__ = "0.1.0"
