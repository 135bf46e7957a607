"""Full-history rate snapshots as Spark DataFrame operators."""

from ratewell.params import Params

__all__ = ["Params"]
