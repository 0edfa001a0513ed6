"""Crawl-corpus and search operators on Spark DataFrames."""

import sys

from pyspark import cloudpickle

from pagelode.options import CrawlOptions, SearchOptions, options_from
from pagelode.session import local_session, workdir

# Python functions travel with their tasks, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

__all__ = ["CrawlOptions", "SearchOptions", "options_from", "local_session", "workdir"]
