"""Datasets split into many files, as one Spark-native grid."""

from .model import Block, DimInfo, FragmentError, FragmentSet, Manifest
from .operators.array import Variable, open_variable
from .operators.merge import batched_create, extend_manifests, incremental_append
from .plans.dataset import Dataset, describe, open_dataset
from .plans.manifest import build_manifest, read_manifest, store_manifest, write_manifest
from .sources.parquet import open_files, open_fragments, write_fragments

__all__ = [
    "Block", "Dataset", "DimInfo", "FragmentError", "FragmentSet", "Manifest", "Variable", "batched_create",
    "build_manifest", "describe", "extend_manifests", "incremental_append", "open_dataset", "open_files", "open_fragments",
    "open_variable", "read_manifest", "store_manifest", "write_fragments", "write_manifest",
]
