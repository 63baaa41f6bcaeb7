"""mercato — marketplace analytics as Spark DataFrame functions.

Canonical commerce tables (orders, payments, customers, reviews, items,
products, category translation, sellers) are turned into one conformed
sales fact and from there into revenue/KPI marts, customer value segments,
RFM scoring, cohort retention, an order-level feature table, MLlib models
and data-quality reports.  Every operator is a plain function
``DataFrame(s) -> DataFrame``; nothing is collected to the driver except
bounded scalars (model-selection costs, pivot column lists).
"""

from mercato.session import get_session, ensure_checkpoint_dir  # noqa: F401

__all__ = ["get_session", "ensure_checkpoint_dir"]
