"""tidemark: longitudinal-cohort analytics as Spark DataFrame plans.

Layout
------
sources/    typed readers, role views over the driver tables, split-partitioned sinks
functions/  Column expressions (flags, time arithmetic, templates, hashing)
operators/  DataFrame -> DataFrame operators (codes, labs, visits, samples, splits,
            aggregation, text, ranking, metrics, classifier)
plans/      end-to-end jobs (prepare, aggregate, train) and the query catalog
streaming/  the stateless operators wired to Structured Streaming sources
"""

from tidemark.config import CohortConfig  # noqa: F401
from tidemark.session import build_session, ensure_checkpoint_dir  # noqa: F401
