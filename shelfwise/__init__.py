"""shelfwise: Spark-native inventory analytics.

Bronze -> silver cleaning, a one-pass gold feature table (sales velocity,
stock on hand, procurement lead time, safety stock, stock-out risk and
reorder point), MLlib random forests for both targets, and rule-based
restocking recommendations. Every data operator is a function from
DataFrame to DataFrame built from native Spark expressions.
"""

from shelfwise.session import get_session, scratch_dir

__all__ = ["get_session", "scratch_dir"]
__version__ = "0.1.0"
