"""cohortix: table audit, cleaning and model evaluation as Spark DataFrame operators.

Entry points: ``cohortix.operators`` (profile, duplicates, clean, stats,
split, metrics, models, shap, verdict, ranking, cumulative),
``cohortix.sources`` (scans and sinks), ``cohortix.functions`` (column
expressions), ``cohortix.plans`` (end-to-end audit / fix / train plans and
the registered query catalog) and ``cohortix.streaming``.
"""

__version__ = "0.1.0"
