"""cantogram: Spark DataFrame jobs for music-catalogue analytics.

Tracks, genre labels and bag-of-words lyrics meet on ``track_id``; the package
reads them, cleans them, and computes yearly trends, genre profiles, ranked
words, lyrical diversity and genre maps, all as Spark plans.
"""

import sys

from pyspark import cloudpickle

__version__ = "0.1.0"

# Functions and classes of this package travel with the jobs that use them, so
# executors need no copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
