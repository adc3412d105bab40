"""Raw readers, conforming views, staging casts and layer writes."""

from churnscope.sources.conform import (  # noqa: F401
    conform_billing,
    conform_customers,
    conform_support,
    conform_usage,
    conformed_tables,
)
from churnscope.sources.staging import stage_all, stage_table  # noqa: F401
from churnscope.sources.tables import read_table  # noqa: F401
