"""fleetlens: fleet monitoring reports as Spark DataFrame plans.

Every report is a pure function from monitoring DataFrames and a
:class:`~fleetlens.params.Params` to a typed DataFrame.  Nothing is
collected to the driver; Catalyst and AQE choose the physical plan.
"""

from fleetlens.params import Params

__all__ = ["Params"]
__version__ = "0.1.0"
