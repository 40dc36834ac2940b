"""martforge — retail order data to dashboard-ready marts on Spark.

Layers:
  sources/    raw text ingest (CSV), declared contracts, test-data adapter, sinks
  functions/  Column -> Column helpers (cleaning, casts, dates, keys, rounding)
  operators/  generic DataFrame operators (latest per key, arg-max, modes,
              conditional counts, rolling / period windows, checks)
  plans/      the model graph: staging, roll-ups, marts, full build

Entry points: ``load_raw`` (CSV -> raw parquet + load report), ``models``
(every model, lazily), ``build`` (marts written + check summary),
``run_suite`` with ``model_suite()`` (the 81 checks).
"""

__version__ = "0.1.0"

from martforge.operators.checks import run_suite  # noqa: E402
from martforge.plans.build import build, staged_models  # noqa: E402
from martforge.plans.graph import models  # noqa: E402
from martforge.plans.rules import model_suite  # noqa: E402
from martforge.sources.csv_ingest import load_raw, read_raw  # noqa: E402

__all__ = ["build", "load_raw", "model_suite", "models", "read_raw", "run_suite", "staged_models"]
