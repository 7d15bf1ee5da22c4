"""strata: a Spark-native medallion pipeline for profit analytics.

Raw orders, customers and products land in a bronze layer, are cleaned and
joined in silver, and summed by year, product category, sub-category and
customer in gold.  Every stage is a plain ``DataFrame -> DataFrame``
function, so Catalyst sees (and optimises) the whole plan; data-quality
checks return DataFrames computed by Spark rather than asserting on the
driver.
"""

from strata.settings import LayerNames, SourceSpec

__all__ = ["LayerNames", "SourceSpec"]
