"""Operations of a training-data pipeline on document, page and vector tables."""

import sys

from pyspark import cloudpickle

# Functions sent to executors travel whole, so that executors need not have this package. They need Spark, numpy, pandas
# and pyarrow; and for near copies xxhash, for pieces sentencepiece and xxhash, for byte pairs regex.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
