"""Change-data-capture lakehouse jobs on PySpark.

Raw row-change events go in; slowly-changing-dimension (type 1) tables, promoted
layers and access audits come out.  Everything is DataFrame in, DataFrame out.
"""

from driftlake.spec import TableSpec

__all__ = ["TableSpec"]
