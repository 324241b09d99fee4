"""forgeline: Spark-native quality, cleansing, feature and evaluation operators
for manufacturing data.  Every operator takes and returns DataFrames.

Modules (import what you need)::

    from forgeline.operators import cleansing, duplicates, profiling, outliers, quality
    from forgeline.operators import features, smote, sequences, evaluation, history, models, images
    from forgeline.streaming import pipelines
    from forgeline.sources import io
    from forgeline.functions.quantiles import exact_quantiles
    from forgeline.functions.ordinals import with_ordinal, running_totals
"""

__version__ = "0.1.0"

__all__ = ["__version__"]
