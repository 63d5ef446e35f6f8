"""Small linear algebra on array columns: one row is one problem, everything stays in the JVM.

A matrix is an array of rows. Matrices here are Gram matrices: symmetric, no pivoting needed. A column that
those before it explain up to ``EPSILON`` of its own length is left out, as a least-norm solver would.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

EPSILON = 1e-11


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays of one length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def gram(columns: Column) -> Column:
    """All products of the columns of a design."""
    return F.transform(columns, lambda a: F.transform(columns, lambda b: dot(a, b)))


def _pivot_share(row: Column, matrix: Column, k: Column, lengths: Column) -> Column:
    """What to take of pivot row ``k``: zero if nothing of that column is left."""
    pivot = F.get(F.get(matrix, k), k)
    return F.when(pivot > F.get(lengths, k) * EPSILON, F.try_divide(F.get(row, k), pivot)).otherwise(0.0)


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once; written out inside a lambda, it would be for every element."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _reduced(row: Column, matrix: Column, k: Column, lengths: Column) -> Column:
    pivot_row = F.get(matrix, k)
    return once(_pivot_share(row, matrix, k, lengths), lambda share: F.zip_with(row, pivot_row, lambda x, p: x - share * p))


def eliminate(matrix: Column, steps: Column, lengths: Column) -> Column:
    """The matrix after the first ``steps`` columns have been eliminated below the diagonal."""

    def all_steps(own: Column) -> Column:
        def step(m: Column, k: Column) -> Column:
            return F.transform(m, lambda row, i: F.when(i > k, _reduced(row, m, k, own)).otherwise(row))

        return F.aggregate(_upto(steps), matrix, step)

    return once(lengths, all_steps)


def corner_path(matrix: Column, steps: Column, lengths: Column) -> Column:
    """The last diagonal entry before and after each of the first ``steps`` eliminations.

    For the Gram matrix of regressors and target these are the residual sums of squares of the
    regressions on the first 0, 1, 2, ... regressors.
    """
    corner = lambda m: F.element_at(F.element_at(m, -1), -1)

    def all_steps(own: Column) -> Column:
        def step(acc: Column, k: Column) -> Column:
            m = acc["m"]
            lower = F.transform(m, lambda row, i: F.when(i > k, _reduced(row, m, k, own)).otherwise(row))
            return once(lower, lambda done: F.struct(done.alias("m"), F.concat(acc["path"], F.array(corner(done))).alias("path")))

        first = F.struct(matrix.alias("m"), F.array(corner(matrix)).alias("path"))
        return F.aggregate(_upto(steps), first, step, lambda acc: acc["path"])

    return once(lengths, all_steps)


def solve(matrix: Column, moments: Column, size: int, lengths: Column) -> Column:
    """Coefficients x of ``matrix`` x = ``moments``, by elimination above and below the diagonal."""
    augmented = F.transform(F.arrays_zip(matrix.alias("r"), moments.alias("b")), lambda z: F.concat(z["r"], F.array(z["b"])))

    def all_steps(own: Column) -> Column:
        def step(m: Column, k: Column) -> Column:
            return F.transform(m, lambda row, i: F.when(i != k, _reduced(row, m, k, own)).otherwise(row))

        def coefficient(row: Column, i: Column) -> Column:
            pivot = F.get(row, i)
            return F.when(pivot > F.get(own, i) * EPSILON, F.try_divide(F.element_at(row, -1), pivot)).otherwise(0.0)

        return F.transform(F.aggregate(F.sequence(F.lit(0), F.lit(size - 1)), augmented, step), coefficient)

    return once(lengths, all_steps)


def diagonal(matrix: Column) -> Column:
    return F.transform(matrix, lambda row, i: F.get(row, i))


def _upto(n: Column) -> Column:
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
