"""The feature tables that are materialised under fixed names."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from starmart.plans.churn import churn_features
from starmart.plans.cross_sell import cross_sell_features
from starmart.plans.customer import customer_features
from starmart.plans.fraud import fraud_features
from starmart.plans.performance import product_performance, regional_analysis
from starmart.sources.writers import publish

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class StarTables:
    """The star schema a feature table reads, and value lists of the cross-sell features that are not read from it."""

    customers: DataFrame
    products: DataFrame
    dates: DataFrame
    facts: DataFrame
    cross_sell_values: Mapping[str, Sequence[str]] = field(default_factory=dict)


#: Table name to builder. Stored tables need no global order, so the sorts of the reports are left out.
FEATURE_TABLES: dict[str, Callable[[StarTables, object], DataFrame]] = {
    "vw_customer_features": lambda s, at: customer_features(s.customers, s.facts, s.dates, at),
    "vw_churn_features": lambda s, at: churn_features(s.customers, s.facts, s.dates, at),
    "vw_cross_sell_features": lambda s, at: cross_sell_features(s.customers, s.facts, s.products, at, **s.cross_sell_values),
    "vw_product_performance": lambda s, at: product_performance(s.products, s.facts, s.dates, ordered=False),
    "vw_regional_analysis": lambda s, at: regional_analysis(s.facts, s.customers, ordered=False),
    "vw_fraud_detection_features": lambda s, at: fraud_features(s.facts, s.dates, ordered=False),
}


def materialize_all(
    star: StarTables, database: str | None = None, as_of=None, tables: Mapping[str, Callable[[StarTables, object], DataFrame]] = FEATURE_TABLES,
) -> list[str]:
    """Write every feature table, skip those whose result is empty, and return the names written."""
    written = []
    for name, build in tables.items():
        table = f"{database}.{name}" if database else name
        if publish(build(star, as_of), table, skip_empty=True):
            written.append(table)
    log.info("materialised %d of %d feature tables", len(written), len(tables))
    return written
