"""lakecart — a batch commerce lakehouse on PySpark.

Layers: relational extract → date-partitioned raw CSV (bronze) → typed, cleaned
Parquet (silver) → aggregate marts (gold) → report queries.  Every step is a
DataFrame transformation planned by Catalyst; nothing runs outside Spark tasks.
"""

from lakecart.session import build_session, scratch_dir

__all__ = ["build_session", "scratch_dir"]
