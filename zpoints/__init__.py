"""zpoints: Z-order (Morton) indexed 3-D point tables on Spark.

Every operator is a DataFrame transformation: nothing is collected to the
driver except bounded planning results (a one-row extent, a box's range list
below a size cap), and no row-at-a-time Python UDF sits in a hot path.
"""

from zpoints.schema import PRECISION, RESOLUTION  # noqa: F401
from zpoints.session import get_spark, checkpoint_dir  # noqa: F401
