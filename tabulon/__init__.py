"""Labelled-table preparation, feature analysis and ensembles on Spark DataFrames."""
from tabulon.spec import BUILDING_DAMAGE, DatasetSpec

__all__ = ["DatasetSpec", "BUILDING_DAMAGE"]
