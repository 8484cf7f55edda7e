"""Scalar column functions (inventory F01-F44): Column -> Column, no UDF.

Every function returns a Spark expression, so it runs inside whole-stage
codegen wherever it is used.  Random draws of the source are replaced by
parameters (defaulting to the middle of the drawn range).
"""

from aislekit.functions.calendar import *  # noqa: F401,F403
from aislekit.functions.pricing import *  # noqa: F401,F403
from aislekit.functions.scores import *  # noqa: F401,F403
from aislekit.functions.text import *  # noqa: F401,F403
