"""Batch annotation of large document collections as Spark jobs."""

import sys

from pyspark import cloudpickle

from annoflow.model import (
    ANNOTATION,
    ANNOTATIONS,
    DOCUMENT,
    RESULT,
    Output,
    JobSpec,
    Selection,
)

__all__ = [
    "ANNOTATION",
    "ANNOTATIONS",
    "DOCUMENT",
    "RESULT",
    "JobSpec",
    "Output",
    "Selection",
]

# Functions sent to Python workers carry their code with them, so executors need
# Python, pyarrow and numpy but not this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
