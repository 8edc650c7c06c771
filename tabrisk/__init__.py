"""tabrisk — tabular risk classification as Spark plans.

Operators take and return DataFrames. Fitted state (medians, modes, scaler
moments, vocabularies) is either a small frozen dataclass of literals or a
DataFrame that is joined back with a size-checked broadcast.
"""

from tabrisk.session import build_session, checkpoint_dir
from tabrisk.spec import TableSpec

__all__ = ["build_session", "checkpoint_dir", "TableSpec"]
