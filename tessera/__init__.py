"""tessera: incident, census and geometry analytics as composable Spark DataFrame operators.

Every public operator takes DataFrames and returns a lazy DataFrame; the caller
decides when to act. Geometry is kept in native Spark columns (points as two
doubles, polygons as nested coordinate arrays or prepared edge lists), so every
predicate stays inside Catalyst and no spatial extension is needed.
"""

__all__ = ["functions", "operators", "sources", "plans"]
