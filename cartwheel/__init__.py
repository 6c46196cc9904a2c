"""cartwheel — retail order analytics as composable Spark DataFrame operators.

Layers (each a pure DataFrame -> DataFrame function, no action inside):

* ``cartwheel.sources``    raw inputs: star-schema mapping, distributed generator,
                           table readers/writers (overwrite, append, schema merge)
* ``cartwheel.operators``  bronze -> silver cleaning, gold aggregates, windows,
                           distributed ranking, data-quality report
* ``cartwheel.plans``      end-to-end pipeline, dashboard datasets, acceptance suite
* ``cartwheel.streaming``  micro-batch form of the quality-history append
* ``cartwheel.functions``  column-expression helpers (exact money/percent rounding,
                           calendar helpers, classification rules)
"""

__version__ = "0.1.0"
