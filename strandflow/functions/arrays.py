"""Array helpers: slicing, pairing, pooling, classes."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def first_k(c: Column, k: int) -> Column:
    return F.slice(c, 1, k)


def paired(left: Column, right: Column, k: int) -> Column:
    """The first k values of both arrays, side by side."""
    return F.concat(first_k(left, k), first_k(right, k))


def one_hot(c: Column, n_classes: int) -> Column:
    return F.transform(
        F.sequence(F.lit(0), F.lit(n_classes - 1)), lambda i: (i == c).cast("int")
    )


def argmax(c: Column) -> Column:
    """0-based place of the largest value; the first one wins a tie."""
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")

