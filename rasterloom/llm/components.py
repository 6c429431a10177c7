"""Connected components of an edge table, with intermediate tables as Parquet in the shared folder."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame

from rasterloom.llm.staging import staged
from rasterloom.operators import graphs


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of edges (a long, b long); a component is named by its smallest node."""
    return graphs.connected_components(edges, partial(staged, name="components"))
