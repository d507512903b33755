"""Scalar functions as Spark SQL text.

Each function takes SQL expressions (usually column names) and returns one, for
``selectExpr`` or ``F.expr``. Text reaches the JVM in one call and is planned there; the
same expressions built call by call from Python take seconds to put together.
"""
