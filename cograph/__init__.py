"""cograph: a PySpark-native engine that turns user-item signals and event logs
into item-item and user-item recommendations.

Every operator is a plain function ``DataFrame(s) -> DataFrame(s)`` written with
the DataFrame API only (no RDDs, no Python UDFs), so Catalyst plans and
optimises the whole chain.
"""

from cograph.params import RecParams

__all__ = ["RecParams"]
