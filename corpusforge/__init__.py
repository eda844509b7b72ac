"""Raw web pages, repository files and documents to instruction-tuning data, on Spark."""

import sys

from pyspark import cloudpickle

from .rules import DomainRules, Limits
from .session import build_session

# The Python functions of this package travel inside the tasks, so executors need no
# copy of the package on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["DomainRules", "Limits", "build_session"]
