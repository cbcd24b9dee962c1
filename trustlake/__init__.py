"""trustlake: trusted tables, features and scores as plain Spark jobs."""

from trustlake.session import get_spark, lineage_cut, work_dir

__all__ = ["get_spark", "lineage_cut", "work_dir"]
