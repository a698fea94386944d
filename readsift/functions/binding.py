"""Evaluate an expensive expression once.

The optimizer pushes filters below projections and copies the filtered expression on the way; inside
a higher-order function a copied expression is then computed per element. Binding the value to a
lambda variable, and filtering inside the generator, keeps it to one evaluation per row.
"""

from pyspark.sql import Column, functions as F


def let(value: Column, body) -> Column:
    """body(value), with the value computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def only(value: Column, keep) -> Column:
    """Generator of the value where keep(value) holds; the row goes otherwise."""
    return F.explode(F.filter(F.array(value), keep))
