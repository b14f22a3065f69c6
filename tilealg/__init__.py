"""tilealg: distributed dense/sparse linear algebra on Spark DataFrames.

Quick start::

    from tilealg import from_relation, vector_from_relation
    s = from_relation(df, "row_key", "col_key", "amount", shape=(25, 25))
    (s @ s).cells()                 # matrix product as an (i, j, v) DataFrame
    s.quad_form(u)                  # one-row DataFrame (value)

``*`` between matrices is element-wise (Hadamard); ``@`` is the matrix product.
"""

from .model import (CELLS, SPARSE, TILES, Shape, ShapeMismatchError, TileMatrix,  # noqa: F401
                    TileVector, scalar)
from .operators.mapops import cos, exp, power, sin, transpose  # noqa: F401
from .operators.product import dot, gram, matmul, matvec, quad_form, vecmat  # noqa: F401
from .operators.reduce import (col_sums, norm, norm_squared, reduce_cols,  # noqa: F401
                               reduce_rows, row_sums, vsum)
from .operators.zipops import approx_equal, fuse, mult_blocks  # noqa: F401
from .session import ensure_checkpoint_dir, local_session  # noqa: F401
from .sources import (check_unique, eye, fill, from_arrays, from_relation,  # noqa: F401
                      generate, generate_tiles, index_keys, load, load_stored,
                      load_stored_vector, load_vector, ones,
                      read_text, read_text_vector, rejected_text, save, sparse_zeros, spd, store, uniform,
                      vec_fill, vec_generate, vec_generate_tiles, vec_ones, vec_uniform,
                      vec_zeros, vector_from_relation, write_text, zeros)

__version__ = "0.1.0"
