"""gradeflow: chat-model evaluation and instruction-data production on Spark.

Everything is a DataFrame operation; the model call (``batch_chat``) is the one
Python boundary. Main entry points:

* ``gradeflow.plans.evals.run`` — items x models -> scores, metrics, leaderboard
* ``gradeflow.operators.generate.generate`` — chat templates x table -> SFT records
* ``gradeflow.operators.distil.run_distillation`` — resumable output filling
* ``gradeflow.streaming`` — the same over arriving files
"""

import sys as _sys

from pyspark import cloudpickle as _cloudpickle

# Model-call stages run gradeflow code in Python workers. Pickling the package
# by value ships that code inside each task, so executors need nothing installed.
_cloudpickle.register_pickle_by_value(_sys.modules[__name__])

from .operators.aggregate import aggregate_results, leaderboard  # noqa: E402
from .operators.distil import run_distillation  # noqa: E402
from .operators.evaluate import score_exam, score_mmlu  # noqa: E402
from .operators.generate import generate  # noqa: E402
from .operators.inference import CallPolicy, batch_chat  # noqa: E402
from .plans.evals import run  # noqa: E402

__all__ = [
    "CallPolicy",
    "aggregate_results",
    "batch_chat",
    "generate",
    "leaderboard",
    "run",
    "run_distillation",
    "score_exam",
    "score_mmlu",
]
