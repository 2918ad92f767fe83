"""Named queries over a data folder, with the SQL each one is checked against."""

# In this order: a module's reference SQL builds on expressions of those before it.
from clientele.plans import revenue_plans  # noqa: F401, I001
from clientele.plans import customer_plans  # noqa: F401
from clientele.plans import rfm_plans  # noqa: F401
from clientele.plans import cohort_plans  # noqa: F401
from clientele.plans import experiment_plans  # noqa: F401
from clientele.plans import forecast_plans  # noqa: F401
from clientele.plans import model_plans  # noqa: F401
from clientele.plans import table_plans  # noqa: F401
