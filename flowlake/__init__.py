"""Network-flow analytics on Spark: decode, enrich, roll up, detect, report."""

from flowlake.config import LakeConfig, open_session

__all__ = ["LakeConfig", "open_session"]
