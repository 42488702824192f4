"""Training-data pipeline operators: decontamination, licence scans, HTML
extraction, exact-substring and near-duplicate removal, packing, PII, secrets,
language identification, hard negatives, spelling variants.  Nothing outside this subpackage imports it."""

import sys

from pyspark import cloudpickle

# Task code travels with the job, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
