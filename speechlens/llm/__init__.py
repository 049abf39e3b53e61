"""Training-data operators: decontamination, near-duplicates, language,
language model, toxicity, personal data, secrets, quality and mixing.

Nothing outside this subpackage imports it. Each operator module has its own
interface; `catalog` holds the thin registered queries over the test tables.

Task functions of this subpackage are sent to the executors by value, so the
package need not be installed there.
"""

import sys

from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])
