"""Column expressions on vectors. All run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from eddyline.schemas import VECTOR_WIDTH


def hash_vector(text: Column, width: int = VECTOR_WIDTH, cell_type: str = "double") -> Column:
    """The 16 md5 bytes of the text scaled to [0, 1] and repeated up to ``width``.

    NULL and '' give the zero vector. The digest is turned into numbers by three
    base conversions (7 + 7 + 2 bytes fit a BIGINT each); bytes come from shifts.
    """
    # '' stands for an all-zero digest rather than another branch around the vector:
    # codegen shares a repeated subexpression only outside conditional branches.
    empty = text.isNull() | (text == "")
    digest = F.when(empty, F.lit("0" * 32)).otherwise(F.md5(text.cast("binary")))
    cells: list[Column] = []
    for start, n_bytes in ((0, 7), (7, 7), (14, 2)):
        hex_part = F.substring(digest, start * 2 + 1, n_bytes * 2)
        number = F.conv(hex_part, 16, 10).cast("bigint")
        for i in range(n_bytes):
            byte = F.shiftright(number, 8 * (n_bytes - 1 - i)).bitwiseAND(F.lit(255))
            cells.append((byte.cast("double") / F.lit(255.0)).cast(cell_type))
    block = F.array(*cells)
    repeated = F.flatten(F.array_repeat(block, -(-width // 16)))
    return repeated if width % 16 == 0 else F.slice(repeated, 1, width)


def stored_hash_vector(text: Column, width: int = VECTOR_WIDTH) -> Column:
    """The hash vector in the 32-bit cells that points are stored with.

    The 16 cells are narrowed before they are repeated; casting the whole array later
    would touch every cell of every row.
    """
    return hash_vector(text, width, "float")


def norm(vector: Column) -> Column:
    return F.sqrt(F.aggregate(vector, F.lit(0.0), lambda acc, x: acc + x * x))


def l2_normalize(vector: Column) -> Column:
    """Unit length; a zero vector stays zero. Computed in double precision."""
    doubles = vector.cast("array<double>")
    length = F.nullif(norm(doubles), F.lit(0.0))
    # array_repeat keeps the norm out of the per-cell lambda, which would redo it.
    lengths = F.array_repeat(F.coalesce(length, F.lit(1.0)), F.size(doubles))
    return F.zip_with(doubles, lengths, lambda x, n: x / n)


def has_width(vector: Column, width: int) -> Column:
    """True only for a vector of exactly ``width`` cells, all of them finite numbers."""
    whole = (F.size(vector) == width) & F.forall(vector, lambda x: F.abs(x) < F.lit(float("inf")))
    # NaN sorts above infinity, and a NULL cell makes the test NULL: neither passes.
    return F.coalesce(whole, F.lit(False))
