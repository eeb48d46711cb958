"""fareflow: fare-history analytics as Spark DataFrame plans.

Every public operator is a pure ``DataFrame -> DataFrame`` function (usable
with ``df.transform``) or a ``Column`` builder.  Nothing collects fact rows
to the driver; heavy work is left to Catalyst/Tungsten.
"""

__version__ = "0.1.0"
