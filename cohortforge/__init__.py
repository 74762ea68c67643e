"""Clinical cohort building and de-identified extracts as Spark DataFrame jobs."""

from cohortforge.config import Rule, StudyConfig
from cohortforge.study import Study
from cohortforge import plans  # registers the stages

__all__ = ["Rule", "Study", "StudyConfig", "plans"]
