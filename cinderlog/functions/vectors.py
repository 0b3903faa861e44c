"""Sparse vectors from and to plain arrays.

MLlib has no SQL function that builds a sparse vector. Its vector type does have a fixed
struct form, and Spark's JSON functions read and write that form inside the JVM.
"""

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

_AS_VECTOR = T.StructType([T.StructField("v", VectorUDT())])
_AS_STRUCT = "v struct<type: int, size: int, indices: array<int>, values: array<double>>"


def sparse_vector(size: int, indices: Column, values: Column) -> Column:
    """Indices must ascend."""
    plain = F.struct(
        F.lit(0).alias("type"), F.lit(size).alias("size"),
        indices.alias("indices"), values.alias("values"),
    )
    return F.from_json(F.to_json(F.struct(plain.alias("v"))), _AS_VECTOR)["v"]


def vector_parts(vector: Column) -> Column:
    """Struct of size, indices and values (indices and size are null for dense vectors)."""
    return F.from_json(F.to_json(F.struct(vector.alias("v"))), _AS_STRUCT)["v"]


def map_sparse(vector: Column, value) -> Column:
    """Apply value(column) to each stored entry of a sparse vector, keeping the rest."""
    parts = vector_parts(vector)
    plain = F.struct(
        F.lit(0).alias("type"), parts["size"].alias("size"),
        parts["indices"].alias("indices"), F.transform(parts["values"], value).alias("values"),
    )
    return F.from_json(F.to_json(F.struct(plain.alias("v"))), _AS_VECTOR)["v"]
