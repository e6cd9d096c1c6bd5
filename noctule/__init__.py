"""noctule: dark-sky site analytics as Spark DataFrame operators."""

from noctule.model import Grid, Region

__all__ = ["Grid", "Region"]
