"""adjudica: a Spark-native claim-decision library.

Feature mart (look-back joins, latest-period joins, history ranks,
insert-if-new and upserts), training targets, feature transforms, a
boosted-tree classifier, cost-based thresholds, decision classes and
audits, all expressed as DataFrame plans.
"""

__version__ = "0.1.0"
