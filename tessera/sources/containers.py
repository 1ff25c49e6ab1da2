"""HDF5 as a Spark data source; it needs the package ``h5py``, asked for only when a file is read.  MCAP: ``sources.mcap``."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition


_VALUES = 1 << 17


class _Files(DataSourceReader):
    """One partition per file of the comma-separated ``path`` option."""

    def __init__(self, options) -> None:
        self.paths = [p for p in options.get("path", "").split(",") if p]
        self.topics = [t for t in options.get("topics", "").split(",") if t]

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(p) for p in self.paths]


class Hdf5Reader(_Files):
    def read(self, partition: InputPartition) -> Iterator[pa.RecordBatch]:
        import h5py

        with h5py.File(partition.value, "r") as f:
            for name in self.topics or list(_datasets(f)):
                data = f[name]
                wide = max(1, int(np.prod(data.shape[1:])))
                rows = max(1, _VALUES // wide)
                for at in range(0, data.shape[0], rows):  # a slice of samples at a time, as one Arrow batch
                    values = np.asarray(data[at : at + rows], np.float64).reshape(-1)
                    n = len(values)
                    sample, element = at + np.arange(n) // wide, (np.arange(n) % wide).astype(np.int32)
                    yield pa.RecordBatch.from_arrays([pa.array([partition.value] * n), pa.array([name] * n), pa.array(sample.astype(np.int64)), pa.array(element), pa.array(values)], names=["path", "dataset", "sample_index", "element", "value"])


def _datasets(group, prefix: str = "") -> Iterator[str]:
    for k, v in group.items():
        yield from _datasets(v, f"{prefix}{k}/") if hasattr(v, "items") else [prefix + k]


class Hdf5(DataSource):
    """Numeric HDF5 datasets as long rows: path, dataset, sample_index, element, value."""

    @classmethod
    def name(cls) -> str:
        return "hdf5_long"

    def schema(self) -> str:
        return "path string, dataset string, sample_index bigint, element int, value double"

    def reader(self, schema) -> DataSourceReader:
        return Hdf5Reader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(Hdf5)
