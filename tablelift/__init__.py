"""Move tables between databases, files and Spark, and prove that nothing was lost."""

from tablelift.formats import FlatFormat
from tablelift.functions.typemap import ColumnSpec
from tablelift.plans.transfer import TransferPlan, run_batch, run_transfer

__all__ = ["ColumnSpec", "FlatFormat", "TransferPlan", "run_batch", "run_transfer"]
