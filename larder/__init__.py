"""larder — Spark-native inventory analytics.

Stock movements, inventory and supplier data go through a bronze → silver →
gold flow of plain DataFrame transformations; the gold feature table feeds
MLlib models, restock recommendations and stock / supplier reports.

Layout:
    sources/    readers, writers and the raw-zone landing job
    functions/  column-level helpers, role resolution, distributed ranking
    operators/  cleaning, features, reports, recommendations, modelling
    plans/      test fixtures and the end-to-end compositions
    streaming/  incremental (availableNow) landing of movement files
"""

__version__ = "0.1.0"
